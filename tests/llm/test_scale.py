"""What the operators write, shuffle and work out again, on rows made here."""

import random

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import sentence_dedup, simhash, vptree
from corpusloom.llm.common import numbered, recorded

SCHEMA = "doc_id long, text string"


def some_rows():
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefgh", k=5)) for _ in range(400)]
    texts = [". ".join(" ".join(draw.choices(words, k=20)).capitalize() for _ in range(4)) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(500 + i, t) for i, t in enumerate(texts[:40])]
    return [*rows, *rows[:30], (None, texts[3]), (None, texts[149] + "!"), (None, None), (900, None), (900, "")]


def written(spark, folder, files=5):
    spark.createDataFrame(some_rows(), SCHEMA).repartition(files).write.parquet(str(folder))
    return spark.read.parquet(str(folder))


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_rows_of_files_are_numbered_without_writing_them(spark, tmp_path):
    docs = written(spark, tmp_path / "docs")
    for rows in (docs, docs.select("text", "doc_id").where("doc_id is null or doc_id % 2 = 0")):
        with recorded() as made:
            found = numbered(rows, "_row", "docs")
        assert not made and found.columns == [*rows.columns, "_row"] and same(found.drop("_row"), rows)
        assert found.select("_row").distinct().count() == rows.count() and same(found, found)


def test_rows_that_cannot_be_told_apart_by_file_are_staged(spark, tmp_path):
    docs = written(spark, tmp_path / "docs")
    twice = spark.read.parquet(str(tmp_path / "docs"), str(tmp_path / "docs"))
    for rows in (docs.union(docs), docs.where(F.rand() < 0.5), docs.select(F.col("doc_id").alias("_source_row"), "text"), twice):
        with recorded() as made:
            found = numbered(rows, "_row", "docs")
        assert found.select("_row").distinct().count() == found.count() and (made or rows is not twice)
        assert found.columns == [*rows.columns, "_row"]
    assert twice.count() == numbered(twice, "_row", "docs").count()


def test_texts_of_a_scan_are_neither_staged_nor_shuffled_to_keep_one(spark, tmp_path, monkeypatch):
    docs = written(spark, tmp_path / "docs")
    by_place = docs.select("*")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with recorded() as made:
            kept = simhash.keep_one(by_place)
            plan = kept._jdf.queryExecution().executedPlan().toString()
            sentence_dedup.remove_repeats(by_place).count()
        assert "SortMergeJoin" not in plan and not [m for m in made if "-docs" in m]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert same(kept, simhash.keep_one(spark.createDataFrame(some_rows(), SCHEMA)))
    monkeypatch.setattr(simhash, "MARKED_ROWS", 0)
    assert same(kept, simhash.keep_one(by_place))


def test_a_fingerprint_has_few_variants():
    cut = simhash._segments(2)
    masks = [simhash._open(*s) for s in cut]
    assert sum(map(len, masks)) == 16
    for distance in range(12):
        for first, width in simhash._segments(distance):
            opened = simhash._open(first, width)
            assert sum(opened) == ((1 << width) - 1) << first and all(a & b == 0 for a, b in zip(opened, opened[1:]))
            assert all(width - m.bit_count() >= min(width - 1, simhash.CLOSED) for m in opened)


def test_leaves_without_nearer_points_are_passed_over(monkeypatch):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(2_000, 8))
    longest = float(np.sqrt((vectors**2).sum(axis=1)).max())
    tree = vptree.Tree(np.arange(2_000), vectors, longest, 6)
    leaves, sorted_rows, plain = sum(len(n) == 1 for n in tree.nodes), [], np.argpartition
    monkeypatch.setattr(vptree.np, "argpartition", lambda a, *x, **y: sorted_rows.append(len(a)) or plain(a, *x, **y))
    rows, _ = tree.search(vectors[:100], 6, 0.0)
    assert sum(sorted_rows) < 100 * leaves / 2
    score = vectors[:100] @ tree.plain.T
    assert all(set(r.tolist()) == set(np.argsort(-s)[:6].tolist()) for r, s in zip(rows, score))
