"""Streams give what batch gives, keep the cap across batches, and resume."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.tokens import ByteTokenizer, PluggedTokenizer
from corpusloom.session import new_folder
from corpusloom.sources.scan import scan_stream
from corpusloom.sources.sinks import read_history
from corpusloom.spec import SourceSpec
from corpusloom.streaming.prepare import BATCH_RECORD, lazy_rows, progress, read_batches, start_prepare, start_shuffle
from suite import queries

SCHEMA = "k long, text string"


@pytest.fixture
def folder(spark):
    return new_folder(spark, "stream")


def add(spark, folder, first, last):
    """One file; every third text is too short."""
    text = F.when(F.col("k") % 3 == 0, "short").otherwise(F.concat(F.lit("a longer text "), F.col("k").cast("string")))
    spark.range(first, last).withColumnRenamed("id", "k").select("k", text.alias("text")).coalesce(1).write.mode(
        "append"
    ).parquet(f"{folder}/in")


def run(spark, folder, cap=None, **options):
    spec = SourceSpec("s", path=f"{folder}/in", key_columns=("k",), max_samples=cap)
    stream = scan_stream(spark, spec, SCHEMA, max_files=1)
    start_prepare(stream, spec, ByteTokenizer(), f"{folder}/out", f"{folder}/checkpoint", **options).awaitTermination()
    return read_batches(spark, f"{folder}/out")


def test_same_as_batch(spark, folder):
    for first in (0, 10, 20):
        add(spark, folder, first, first + 10)
    got = run(spark, folder)
    spec = SourceSpec("s", key_columns=("k",), max_samples=None)
    batch = lazy_rows(spark.read.parquet(f"{folder}/in"), spec, ByteTokenizer(), None)
    columns = ["source", "row_key", "input_ids", "attention_mask"]
    assert sorted(got.select(*columns).collect()) == sorted(batch.select(*columns).collect())
    assert got.count() == 20 and got.select("batch").distinct().count() == 3


@pytest.mark.parametrize("cap,direct", [(0, 100), (1, 100), (14, 100), (14, 2), (100, 100)])
def test_cap_counts_over_batches(spark, folder, cap, direct):
    for first in (0, 10, 20):
        add(spark, folder, first, first + 10)
    got = run(spark, folder, cap, direct=direct)
    assert got.count() == min(cap, 20)
    history = read_history(spark, f"{folder}/out/history", BATCH_RECORD)
    assert history.agg(F.sum("rows")).first()[0] == min(cap, 20)


def test_plugged_tokenizer_streams_the_same(spark, folder):
    add(spark, folder, 0, 20)
    native = run(spark, folder, cap=9).select("row_key", "input_ids").sort("row_key").collect()
    plugged = PluggedTokenizer(lambda: lambda texts: [[1, *[b + 3 for b in t.encode()]] for t in texts])
    spec = SourceSpec("s", key_columns=("k",))
    got = lazy_rows(spark.read.parquet(f"{folder}/in"), spec, plugged, 9)
    assert got.select("row_key", "input_ids").sort("row_key").collect() == native


def test_resume_takes_new_files_only(spark, folder):
    add(spark, folder, 0, 10)
    assert run(spark, folder, cap=9).count() == 6
    assert run(spark, folder, cap=9).count() == 6
    add(spark, folder, 10, 20)
    got = run(spark, folder, cap=9)
    assert got.count() == 9 and {r.batch for r in got.select("batch").collect()} == {0, 1}


def test_min_tokens(spark, folder):
    add(spark, folder, 0, 10)
    assert run(spark, folder, min_tokens=17).count() == 0


def test_shuffle_per_batch(spark, folder):
    add(spark, folder, 0, 10)
    add(spark, folder, 10, 30)
    spec = SourceSpec("s", path=f"{folder}/in", key_columns=("k",))
    stream = scan_stream(spark, spec, SCHEMA, max_files=1)
    start_shuffle(stream, spec, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    got = read_batches(spark, f"{folder}/out")
    sizes = sorted(r.n for r in got.groupBy("batch").agg(F.max("row_index").alias("n")).collect())
    assert sizes == [10, 20] and got.count() == 30


def test_two_sources_share_an_output(spark, folder):
    add(spark, folder, 0, 10)
    for name in ("a/b", "c"):
        spec = SourceSpec(name, path=f"{folder}/in", key_columns=("k",), max_samples=4)
        start_prepare(scan_stream(spark, spec, SCHEMA), spec, ByteTokenizer(), f"{folder}/out", f"{folder}/{name}").awaitTermination()
    got = read_batches(spark, f"{folder}/out").groupBy("source").count().collect()
    assert {r.source: r["count"] for r in got} == {"a/b": 4, "c": 4}


def test_another_checkpoint_is_refused(spark, folder):
    add(spark, folder, 0, 10)
    run(spark, folder)
    spec = SourceSpec("s", path=f"{folder}/in", key_columns=("k",))
    with pytest.raises(Exception, match="another checkpoint"):
        start_prepare(scan_stream(spark, spec, SCHEMA), spec, ByteTokenizer(), f"{folder}/out", f"{folder}/new").awaitTermination()
    assert read_batches(spark, f"{folder}/out").count() == 6


def test_a_capped_stream_encodes_each_text_once(spark, folder):
    add(spark, folder, 0, 30)
    encoded = spark.sparkContext.accumulator(0)

    def load():
        def call(texts):
            encoded.add(len(texts))
            return [[1, *[b + 3 for b in t.encode()]] for t in texts]

        return call

    spec = SourceSpec("s", path=f"{folder}/in", key_columns=("k",), max_samples=7)
    stream = scan_stream(spark, spec, SCHEMA)
    start_prepare(stream, spec, PluggedTokenizer(load), f"{folder}/out", f"{folder}/checkpoint", direct=2).awaitTermination()
    assert read_batches(spark, f"{folder}/out").count() == 7
    assert encoded.value == 20


def test_progress_counts_each_batch_once(spark, folder):
    add(spark, folder, 0, 30)
    run(spark, folder, cap=25)
    add(spark, folder, 30, 45)
    run(spark, folder, cap=25)
    run(spark, folder, cap=25)
    got = sorted(tuple(r) for r in progress(spark, f"{folder}/out").collect())
    assert got == [("s", 0, 30, 20, 10, 20), ("s", 1, 15, 5, 10, 25)]


def documents(spark, tmp_path, files):
    """A documents table of so many files: 12 documents, every third in German."""
    lang = F.when(F.col("id") % 3 == 0, "de").otherwise("en").alias("lang")
    text = F.concat(F.lit("a text that is long enough, number "), F.col("id").cast("string")).alias("text")
    rows = spark.range(0, 12, 1, files).select(F.col("id").alias("doc_id"), text, lang, F.lit("web").alias("source"), F.lit(36).cast("long").alias("n_chars"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name,expected", [("stream_prepare", 8), ("stream_shuffle", 12), ("stream_two_sources", 12)])
def test_queries_stream_tables_of_several_files(spark, tmp_path, name, expected):
    got = queries.REGISTRY[name](spark, documents(spark, tmp_path, 3))
    assert got.count() == expected == got.select("row_key").distinct().count()


@pytest.mark.parametrize("name", ["stream_resume", "stream_progress"])
def test_queries_write_their_input_in_several_tasks(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(queries, "new_folder", lambda session, kind: f"{tmp_path}/{kind}")
    got = queries.REGISTRY[name](spark, documents(spark, tmp_path, 3))
    assert {r["n"] for r in got.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()} == ({8, 4} if name == "stream_resume" else {1})
    assert len(list(tmp_path.glob(f"{name.removeprefix('stream_')}/in/*.parquet"))) == 6
