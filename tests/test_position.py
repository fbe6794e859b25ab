"""Caps of sources without a key, by file and row number."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.position import FILE, PLACE, ROW, cap_by_position, positioned
from corpusloom.operators.select import text_rows
from corpusloom.sources.scan import build_corpus, scan
from corpusloom.spec import SourceSpec

TEXT = "a text that is long enough"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """40 files of 25 rows, of two languages; a quarter of all texts are short."""
    path = str(tmp_path_factory.mktemp("a folder") / "web")
    text = F.when(F.col("id") % 4 == 1, "short").otherwise(F.concat(F.lit(TEXT + " "), F.col("id").cast("string")))
    rows = spark.range(0, 1_000, 1, 20).select("id", text.alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"))
    rows.write.partitionBy("lang").parquet(path)
    return path


def in_order(spark, path):
    """All rows as (place, row, id, text), in the order of positions."""
    rows = positioned(spark.read.parquet(path), path).select(PLACE, ROW, "id", "text").collect()
    return sorted(map(tuple, rows))


def files_read(rows):
    """How many files the scans of an executed plan have opened."""
    plan = rows._jdf.queryExecution().executedPlan()
    plan.execute().count()

    def scans(node):
        if "FileSourceScan" in node.getClass().getSimpleName():
            return node.metrics().get("numFiles").get().value()
        below = node.children()
        return sum(scans(below.apply(i)) for i in range(below.size()))

    return scans(plan)


@pytest.mark.parametrize("n", [0, 1, 24, 25, 26, 250, 499, 1_000, 5_000, None])
def test_caps_equal_plain_order(spark, folder, n):
    every, rows = in_order(spark, folder), positioned(spark.read.parquet(folder), folder)
    kept = [r for r in every if r[3] != "short"]
    got = cap_by_position(rows, n).select(PLACE, ROW, "id", "text").collect()
    assert sorted(map(tuple, got)) == every[:n]
    got = cap_by_position(rows, n, F.col("text") != "short", direct=5).select(PLACE, ROW, "id", "text").collect()
    assert sorted(map(tuple, got)) == kept[:n]


def test_only_leading_files_are_read_and_nothing_is_exchanged(spark, folder, capsys):
    spec = SourceSpec("web", path=folder, max_samples=60, streaming=True)
    capped = text_rows(scan(spark, spec), spec)
    capped.explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert files_read(capped) <= 5 < 40 and capped.count() == 60
    assert {r.row_key.split("/")[0] for r in capped.collect()} == {"lang=de"}


def test_subsets_are_counted_by_themselves(spark, folder):
    spec = SourceSpec("web", path=folder, config="en", subset_column="lang", max_samples=30)
    capped = text_rows(scan(spark, spec), spec)
    want = [r for r in in_order(spark, folder) if r[0].startswith("lang=en")][:30]
    assert sorted(r.text for r in capped.collect()) == sorted(r[3] for r in want if r[3] != "short")


def test_row_keys_do_not_depend_on_where_the_folder_lies(spark, folder, tmp_path):
    copy = str(tmp_path / "moved" / "web")
    import shutil

    shutil.copytree(folder, copy)
    keys = [
        {r.row_key for r in text_rows(scan(spark, spec), spec).collect()}
        for spec in (SourceSpec("web", path=p, max_samples=None) for p in (folder, copy))
    ]
    assert keys[0] == keys[1] and len(keys[0]) == 750


def test_caps_that_bind_are_told(spark, folder):
    def told(cap, **options):
        return build_corpus(spark, [SourceSpec("web", path=folder, max_samples=cap, **options)]).capped

    assert told(60) == told(60, streaming=True) == {"web": 60}
    assert told(1_000) == told(5_000) == told(None) == told(750, streaming=True) == {}
    assert told(60, key_columns=("id",)) == {"web": 60} and told(1_000, key_columns=("id",)) == {}
    assert told(749, key_columns=("id",), streaming=True) == {"web": 749}
    assert told(750, key_columns=("id",), streaming=True) == {}


def test_other_tables_are_keyed_by_content(spark, folder):
    rows = spark.read.parquet(folder)
    # Rows that are not one row of a file each have no position.
    twice = rows.withColumn("twice", F.explode(F.array(F.lit(1), F.lit(2))))
    for other in (twice, rows.union(rows), rows.crossJoin(spark.range(2)), rows.limit(5), rows.groupBy("id").count(), spark.range(3)):
        assert positioned(other) is None
    assert positioned(rows.where("id > 3").select("text")).count() == 996
    got = text_rows(twice, SourceSpec("web", max_samples=60))
    assert got.count() == got.select("row_key").distinct().count() and not got.where(F.contains("row_key", F.lit(".parquet"))).count()
    assert text_rows(rows.select("text"), SourceSpec("web", max_samples=None)).count() == 750


def test_columns_of_the_source_may_be_named_like_metadata(spark, tmp_path):
    path = str(tmp_path / "odd")
    spark.range(10).select(F.lit(TEXT).alias("text"), F.col("id").alias("_metadata")).write.parquet(path)
    spec = SourceSpec("odd", path=path, max_samples=4)
    assert text_rows(scan(spark, spec), spec).count() == 4
    assert FILE in positioned(scan(spark, spec)).columns
