"""Tokenizers and the tokenize step."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.tokens import (
    ByteTokenizer,
    PluggedTokenizer,
    SpecialIds,
    VocabTokenizer,
    build_vocabulary,
    id_table,
    map_batches,
    tokenize,
)
from corpusloom.plans.prepare import batch_rows

TEXTS = ["", "a", "héllo \U0001F600 wörld", "x\x00y\n\tz", "the the the cat", " lead and trail \n", "\x85\xa0 odd", "q" * 5_000]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def encode_bytes(text, limit=2048):
    return [1, *(b + 3 for b in text.encode())][:limit]


def ids_of(rows, tokenizer, limit=2048):
    got = tokenizer.attach(rows).select(
        "id", tokenizer.ids(F.col("text"), limit).alias("ids"), tokenizer.count(F.col("text"), limit).alias("n")
    )
    found = {r.id: list(r.ids) for r in got.collect()}
    assert {r.id: r.n for r in got.collect()} == {k: len(v) for k, v in found.items()}
    return [found[i] for i in range(len(found))]


@pytest.mark.parametrize("limit", [2048, 5, 1])
def test_bytes(rows, limit):
    assert ids_of(rows, ByteTokenizer(), limit) == [encode_bytes(t, limit) for t in TEXTS]


@pytest.mark.parametrize("limit", [2048, 3])
def test_plugged(rows, limit):
    def load():
        return lambda texts: [[1, *[b + 3 for b in t.encode()]] for t in texts]

    assert ids_of(rows, PluggedTokenizer(load), limit) == [encode_bytes(t, limit) for t in TEXTS]


def pieces(text):
    for mark in "\n\t\r":
        text = text.replace(mark, " ")
    return [p for p in text.split(" ") if p]


@pytest.mark.parametrize("size", [8, 32_000])
def test_vocabulary(rows, size):
    counts = Counter(p for t in TEXTS for p in pieces(t))
    order = sorted(counts, key=lambda p: (-counts[p], p.encode()))[: size - 3]
    table = {p: i for i, p in enumerate(order, 3)}
    vocabulary = build_vocabulary(rows, size=size)
    assert {r.piece: r.id for r in vocabulary.collect()} == table
    expected = [[1, *(table.get(p, 0) for p in pieces(t))] for t in TEXTS]
    assert ids_of(rows, VocabTokenizer(vocabulary)) == expected


def test_id_table_has_no_join_per_piece(rows, capsys):
    vocabulary = build_vocabulary(rows)
    assert len(id_table(vocabulary).first()["ids"]) == 1 << 16
    tokenize(rows, VocabTokenizer(vocabulary)).explain()
    main = capsys.readouterr().out.split("Subqueries")[0]
    assert "_id_table" in main or "Subquery" in main


def test_tokenize_filters_and_truncates(spark):
    rows = spark.createDataFrame([(30, "a" * 30), (31, "a" * 31), (5_000, "a" * 5_000)], "n int, text string")
    for tokenizer in (ByteTokenizer(), PluggedTokenizer(lambda: lambda ts: [[1, *[100] * len(t)] for t in ts])):
        got = {r.n: r for r in tokenize(rows, tokenizer).collect()}
        assert {n: len(r.input_ids) for n, r in got.items()} == {31: 32, 5_000: 2048}
        assert all(r.input_ids[0] == 1 and list(r.attention_mask) == [1] * len(r.input_ids) for r in got.values())
        assert "text" not in tokenize(rows, tokenizer).columns
        assert tokenize(rows, tokenizer, min_tokens=10).count() == 3


def test_public_tokenizer_plugs_in(spark):
    public = pytest.importorskip("public_tokenizers")
    processor = pytest.importorskip("sentencepiece")
    path = public.path("piece_bpe_32k.model")

    def load():
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [[1, *ids] for ids in model.encode(texts, num_threads=1)]

    rows = spark.createDataFrame([(0, "The cat sat on the mat."), (1, "Grüße aus 中文")], "id int, text string")
    model = processor.SentencePieceProcessor(model_file=path)
    expected = [[1, *model.encode(t)] for t in ("The cat sat on the mat.", "Grüße aus 中文")]
    assert ids_of(rows, PluggedTokenizer(load)) == expected


def test_plugged_tokenizer_runs_once_per_text(rows, capsys):
    tokenize(rows, PluggedTokenizer(lambda: lambda texts: [[1] * 40 for _ in texts])).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_batches_with_any_tokenizer(spark):
    rows = spark.range(50).select(
        F.lit("s").alias("source"), F.col("id").cast("string").alias("row_key"),
        F.concat(F.lit("x" * 30), F.col("id").cast("string")).alias("text"),
    )
    plugged = PluggedTokenizer(lambda: lambda texts: [[1, *[b + 3 for b in t.encode()]] for t in texts])
    native, other = (batch_rows(rows, tokenizer, 8).sort("batch_id", "batch_row").collect()
                     for tokenizer in (ByteTokenizer(), plugged))
    columns = ("batch_id", "batch_row", "input_ids", "attention_mask", "labels")
    assert [[r[c] for c in columns] for r in native] == [[r[c] for c in columns] for r in other]
    assert len(native) == 48 and len({len(r.labels) for r in native if r.batch_id == 0}) == 1


def test_special_ids():
    assert SpecialIds() == SpecialIds(1, 2, 0)
    assert SpecialIds.of_tokenizer(bos=5, eos=6) == SpecialIds(5, 6, 6)
    assert SpecialIds.of_tokenizer(bos=0, eos=7, pad=3) == SpecialIds(1, 7, 3)
    assert SpecialIds.of_tokenizer() == SpecialIds(1, 2, 0)


def test_map_batches(rows):
    def twice(frame):
        return frame[frame["id"] > 2].assign(twice=lambda kept: kept["id"] * 2)[["twice"]]

    got = map_batches(rows, twice, "twice int")
    assert sorted(r.twice for r in got.collect()) == [6, 8, 10, 12, 14]


def test_a_plugged_tokenizer_holds_few_ids_at_once(spark):
    def load():
        def call(texts):
            assert len(texts) == 1 or sum(map(len, texts)) <= 1 << 18
            return [[len(t), *t.encode()] for t in texts]

        return call

    text = F.expr("repeat(chr(97 + id % 26), cast(id % 400 * 10 as int))")
    rows = spark.range(0, 3_000, 1, 1).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("row_key"), text.alias("text"))
    got = tokenize(rows, PluggedTokenizer(load), min_tokens=0).collect()
    assert len(got) == 3_000
    for r in got:
        n = int(r.row_key) % 400 * 10
        assert r.input_ids == [n, *[97 + int(r.row_key) % 26] * n][:2048]
