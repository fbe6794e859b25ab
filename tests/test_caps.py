"""Caps and cuts against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.cutoff import cap_kept, cap_scanned, content_key, lowest_by_hash, nth_key
from corpusloom.operators.select import latest_n, text_rows
from corpusloom.spec import SourceSpec


def ids(rows, column="k"):
    return sorted(r[column] for r in rows.select(column).collect())


@pytest.fixture(scope="module")
def short_rows(spark):
    texts = ["a" * 10, "short", "tiny", "b" * 11, "c" * 12, "d" * 13]
    return spark.createDataFrame(list(enumerate(texts, 1)), "k long, text string")


def test_cap_after_and_before_filter(short_rows):
    lazy = SourceSpec("s", streaming=True, max_samples=3, key_columns=("k",))
    batch = SourceSpec("s", streaming=False, max_samples=3, key_columns=("k",))
    assert ids(text_rows(short_rows, lazy), "row_key") == ["1", "4", "5"]
    assert ids(text_rows(short_rows, batch), "row_key") == ["1"]


@pytest.mark.parametrize("cap,expected", [(0, 0), (3, 3), (6, 6), (100, 6), (None, 6)])
def test_cap_edges(short_rows, cap, expected):
    assert cap_scanned(short_rows, ["k"], cap).count() == expected
    assert cap_kept(short_rows, ["k"], cap, F.lit(True)).count() == expected
    assert cap_kept(short_rows, ["k"], cap, F.lit(True), direct=1).count() == expected


def test_default_caps():
    assert SourceSpec("s").batch_cap == 100_000 and SourceSpec("s").stream_cap is None
    assert SourceSpec("s", max_samples=float("inf")).batch_cap is None
    assert SourceSpec("s", max_samples=5).batch_cap == SourceSpec("s", max_samples=5).stream_cap == 5


def test_numbers_are_ordered_as_numbers(spark):
    rows = spark.createDataFrame([(i,) for i in range(1, 21)], "k long")
    assert ids(cap_scanned(rows, ["k"], 3)) == [1, 2, 3]


@pytest.mark.parametrize("n", [1, 50, 777, 5_000, 9_000, 9_999, 10_000])
@pytest.mark.parametrize("partitions", [1, 7])
def test_large_caps_are_exact(spark, n, partitions):
    """Narrowing by pivots, on very uneven keys, agrees with sorting."""
    random.seed(7)
    keys = random.sample(range(100), 100) + random.sample(range(10**6, 10**12), 9_900)
    rows = spark.createDataFrame([(k, k % 3 > 0) for k in keys], "k long, good boolean").repartition(partitions)
    assert ids(cap_scanned(rows, ["k"], n, direct=20)) == sorted(keys)[:n]
    good = sorted(k for k in keys if k % 3 > 0)
    assert ids(cap_kept(rows, ["k"], n, F.col("good"), direct=20)) == good[:n]


def test_large_cap_on_composite_and_string_keys(spark):
    keys = [(i % 7, f"{i * 37 % 5000:x}") for i in range(5_000)]
    rows = spark.createDataFrame(keys, "a int, b string").repartition(5)
    got = cap_scanned(rows, ["a", "b"], 1_234, direct=30)
    assert sorted((r.a, r.b) for r in got.collect()) == sorted(keys)[:1_234]
    got = cap_scanned(rows, ["a", "b"], 12)
    assert sorted((r.a, r.b) for r in got.collect()) == sorted(keys)[:12]


def test_null_key_comes_first(spark):
    rows = spark.createDataFrame([(None,)] + [(i,) for i in range(3_000)], "k long")
    for direct in (10_000, 20):
        got = [r.k for r in cap_scanned(rows, ["k"], 1_000, direct=direct).collect()]
        assert sorted(got, key=lambda k: -1 if k is None else k) == [None, *range(999)]


def test_rare_rows_far_into_the_source(spark):
    """The head that is tested grows until enough rows pass."""
    rows = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") > 15_000).alias("good"))
    assert ids(cap_kept(rows, ["k"], 100, F.col("good"), direct=20)) == list(range(15_001, 15_101))


def test_repeated_keys_are_an_error_not_a_hang(spark):
    rows = spark.range(5_000).select((F.col("id") % 2).alias("k"))
    with pytest.raises(ValueError, match="do not identify rows"):
        nth_key(rows, ["k"], 1_000, direct=20)


def test_cap_reaches_the_file_scan(spark, tmp_path, capsys):
    spark.range(1_000).select(F.col("id").alias("k"), F.lit("some longer text").alias("text")).write.parquet(
        str(tmp_path / "t")
    )
    rows = spark.read.parquet(str(tmp_path / "t"))
    cap_scanned(rows, ["k"], 10).explain()
    assert "LessThanOrEqual(k,9)" in capsys.readouterr().out
    cap_scanned(rows, ["k"], 500, direct=20).explain()
    plan = capsys.readouterr().out
    assert "LessThanOrEqual(k,499)" in plan and "Exchange" not in plan


def test_content_key_numbers_copies(spark):
    rows = spark.createDataFrame([("a",)] * 25 + [("b",)] + [(None,)] * 3, "text string")
    got = content_key(rows, chunk=4)
    assert got.count() == 29
    assert got.select("content_key", "copy_no").distinct().count() == 29
    copies = {r.text: r.n for r in got.groupBy("text").agg(F.max("copy_no").alias("n")).collect()}
    assert copies == {"a": 24, "b": 0, None: 2}


def test_source_without_key(spark):
    rows = spark.createDataFrame([("some text of a row",)] * 6 + [("another text of a row",)] * 3, "text string")
    spec = SourceSpec("s", max_samples=7)
    for partitions in (1, 4):
        got = text_rows(rows.repartition(partitions), spec)
        assert got.count() == 7 and got.select("row_key").distinct().count() == 7


@pytest.mark.parametrize("share,expected", [(0.0, 0), (0.01, 10), (0.0101, 11), (0.5, 500), (1.0, 1_000)])
def test_lowest_by_hash_share(spark, share, expected):
    rows = spark.range(1_000).select("id", F.md5(F.col("id").cast("string")).alias("h"))
    got = lowest_by_hash(rows, "h", share)
    ranked = [r.id for r in rows.orderBy("h").collect()]
    assert ids(got.where("chosen"), "id") == sorted(ranked[:expected])
    assert got.count() == 1_000


def test_lowest_by_hash_per_group(spark):
    rows = spark.range(1_000).select(
        "id", F.when(F.col("id") < 900, "big").when(F.col("id") < 990, "mid").otherwise("none").alias("g"),
        F.md5(F.col("id").cast("string")).alias("h"),
    )
    quota = spark.createDataFrame([("big", 100), ("mid", 500), ("absent", 5)], "g string, quota long")
    got = lowest_by_hash(rows, "h", quota, ["g"])
    counts = {r.g: r.n for r in got.where("chosen").groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert counts == {"big": 100, "mid": 90} and got.count() == 1_000


def test_latest_n_limits_before_the_exchange(spark, capsys):
    rows = spark.range(1_000).select((F.col("id") % 3).alias("run"), F.col("id").alias("step"))
    got = latest_n(rows, "run", "step", 5)
    assert ids(got, "step") == list(range(985, 1_000))
    got.explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") >= 2


def test_one_repeated_key_is_an_error(spark):
    rows = spark.range(5_000).select(F.lit(7).alias("k"), "id")
    with pytest.raises(ValueError, match="do not identify rows"):
        cap_scanned(rows, ["k"], 700, direct=20).count()


def test_pairs_of_keys_do_not_overshoot(spark):
    rows = spark.range(4_000).select((F.col("id") / 2).cast("long").alias("k"))
    with pytest.raises(ValueError, match="do not identify rows"):
        cap_scanned(rows, ["k"], 999, direct=20).count()


@pytest.mark.parametrize("n", [9, 999, 9_999])
def test_repeated_keys_raise_at_any_cap(spark, n):
    rows = spark.range(30_000).select((F.col("id") / 2).cast("long").alias("k"))
    for direct in (20, 10_000):
        with pytest.raises(ValueError, match="do not identify rows"):
            cap_scanned(rows, ["k"], n, direct=direct)
        with pytest.raises(ValueError, match="do not identify rows"):
            cap_kept(rows, ["k"], n, F.col("k") >= 0, direct=direct)


def test_small_caps_merge_no_top_n_of_the_source(spark, capsys):
    rows = spark.range(50_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("j"))
    cap_scanned(rows, ["j", "k"], 10).explain()
    plan = capsys.readouterr().out
    assert "TakeOrdered" not in plan and "Exchange" not in plan and "j#" in plan
    assert cap_scanned(rows, ["j", "k"], 10).count() == 10


def test_content_key_tells_all_values_apart(spark):
    rows = spark.sql("""
        select * from values (timestamp'2024-01-01 00:00:00.000001', 1D), (timestamp'2024-01-01 00:00:00.000002', 1D),
        (timestamp'2024-01-01 00:00:00.000002', null), (null, 1D), (null, null) as t(at, x)""")
    assert content_key(rows).select("content_key").distinct().count() == 5
    ntz = rows.select(F.col("at").cast("timestamp_ntz").alias("at"))
    assert content_key(ntz).select("content_key").distinct().count() == 3
    assert cap_scanned(content_key(rows), ["content_key", "copy_no"], 1).count() == 1
