"""Shuffle, index, split and mixture do not depend on partitions or read order."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.batches import assign_batches, collate
from corpusloom.operators.mixture import mixture, mixture_report, quotas
from corpusloom.operators.order import global_index, shuffle_seeded, split_exact, split_hash
from corpusloom.spec import SourceSpec

KEYS = [(s, str(i)) for s, n in (("big", 700), ("mid", 250), ("small", 50)) for i in range(n)]
SPECS = [SourceSpec("big", weight=0.5), SourceSpec("mid", weight=0.3, category="code"),
         SourceSpec("small", weight=0.2, category="code")]


def by_hash(keys, seed=42, tag=""):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{tag}{seed}|{k[0]}|{k[1]}".encode()).hexdigest(), k))


@pytest.fixture(scope="module", params=[1, 4, 16])
def rows(request, spark):
    keys = KEYS if request.param != 4 else KEYS[::-1]
    return spark.createDataFrame(keys, "source string, row_key string").repartition(request.param)


@pytest.mark.parametrize("seed", [42, 7])
def test_shuffle_order(rows, seed):
    for parts in (1, 5):
        got = shuffle_seeded(rows, seed, parts)
        assert [(r.source, r.row_key) for r in got.collect()] == by_hash(KEYS, seed)


def test_shuffle_has_one_exchange(rows, capsys):
    shuffle_seeded(rows.coalesce(1)).explain()
    assert capsys.readouterr().out.count("Exchange shufflepartitionid") == 1


def test_global_index(rows):
    got = {r.row_index: (r.source, r.row_key) for r in global_index(rows).collect()}
    assert got == dict(enumerate(by_hash(KEYS), 1))


def test_split_exact(rows):
    got = split_exact(rows).collect()
    test = {(r.source, r.row_key) for r in got if r.split == "test"}
    assert test == set(by_hash(KEYS, tag="split|")[: math.ceil(0.01 * len(KEYS))]) and len(got) == len(KEYS)


def test_split_hash_is_stable_under_appends(spark, rows):
    label = {(r.source, r.row_key): r.split for r in split_hash(rows).collect()}
    assert set(label.values()) == {"train", "test"} and len(label) == len(KEYS)
    more = rows.unionByName(spark.createDataFrame([("new", str(i)) for i in range(100)], "source string, row_key string"))
    again = {(r.source, r.row_key): r.split for r in split_hash(more).collect()}
    assert all(again[k] == v for k, v in label.items())


def test_mixture(rows):
    assert quotas(SPECS, 200) == {"big": 100, "mid": 60, "small": 40}
    got = {(r.source, r.row_key) for r in mixture(rows, SPECS, 200).collect()}
    expected = set()
    for name, quota in quotas(SPECS, 200).items():
        expected |= set([k for k in by_hash(KEYS, tag="mixture|") if k[0] == name][:quota])
    assert got == expected
    assert mixture(rows, SPECS, 10_000).count() == len(KEYS)


def test_split_of_a_mixture_takes_from_every_source(spark):
    keys = [(s, str(i)) for s, n in (("a", 2_000), ("b", 20_000)) for i in range(n)]
    specs = [SourceSpec("a", weight=0.5), SourceSpec("b", weight=0.5)]
    mixed = mixture(spark.createDataFrame(keys, "source string, row_key string"), specs, 4_000)
    test = split_exact(mixed, 0.1).where("split = 'test'").groupBy("source").count().collect()
    assert sum(r["count"] for r in test) == 400 and all(150 < r["count"] < 250 for r in test) and len(test) == 2


def test_small_share(spark):
    rows = spark.range(200_000).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("row_key"))
    assert 2 <= split_hash(rows, 0.00004).where("split = 'test'").count() <= 20


def test_mixture_report(rows):
    got = {r.category: r for r in mixture_report(rows, SPECS, {"text": 0.6}).collect()}
    assert (got["text"].rows, got["text"].observed_share, got["text"].weight_share) == (700, 0.7, 0.5)
    assert (got["code"].sources, got["code"].rows, got["code"].declared_share) == (2, 300, None)


def test_batches_cover_the_shuffled_rows(rows):
    got = assign_batches(rows, 16).collect()
    assert len(got) == 1_000 // 16 * 16
    placed = {(r.batch_id, r.batch_row): (r.source, r.row_key) for r in got}
    assert [placed[divmod(i, 16)] for i in range(len(got))] == by_hash(KEYS)[: len(got)]
    assert assign_batches(rows, 16, drop_last=False).count() == 1_000


def test_drop_last(spark):
    ten = spark.createDataFrame(KEYS[:10], "source string, row_key string")
    assert sorted(r.batch_id for r in assign_batches(ten, 4).collect()) == [0] * 4 + [1] * 4


@pytest.mark.parametrize("by_position,labels", [(False, [-100, 5, -100, -100]), (True, [0, 5, -100, -100])])
def test_collate(spark, by_position, labels):
    rows = spark.createDataFrame(
        [(0, [0, 5], [1, 1]), (0, [1, 2, 3, 4], [1] * 4)], "batch_id long, input_ids array<int>, attention_mask array<int>"
    )
    short = collate(rows, pad_id=0, mask_by_position=by_position).where(F.array_contains("labels", -100)).first()
    assert (short.input_ids, short.attention_mask, short.labels) == ([0, 5, 0, 0], [1, 1, 0, 0], labels)
