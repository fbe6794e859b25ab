"""Seeded order: shuffle, global row index, and train/test split.

All three use row hashes, so they give one answer for any partitioning. The split has
hashes of its own: it does not depend on the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.hashing import hash_number, hash_shard, in_share, row_hash
from corpusloom.operators.cutoff import lowest_by_hash
from corpusloom.spec import SEED, TEST_SHARE

HASH = "row_hash"
SPLIT = "split"


def with_hash(rows: DataFrame, seed: int = SEED, purpose: str = "") -> DataFrame:
    """Add the row hash of ``(source, row_key)`` for a purpose."""
    return rows.withColumn(HASH, row_hash(F.col("source"), F.col("row_key"), seed, purpose))


def shuffle_seeded(
    rows: DataFrame, seed: int = SEED, partitions: int | None = None, within: Sequence[str] = ()
) -> DataFrame:
    """All rows in hash order, partition after partition.

    Hashes are uniform, so the range of each partition is known without the
    sampling pass a range exchange needs: one exchange, then a local sort. With
    ``within``, each partition is sorted by those columns first, as a writer that
    partitions its files by them needs it.
    """
    parts = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.floor(hash_number(F.col(HASH)) * F.lit(parts) / F.lit(float(1 << 32))).cast("int")
    placed = with_hash(rows, seed).repartitionById(parts, place)
    return placed.sortWithinPartitions(*within, HASH, "source", "row_key")


def global_index(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``row_index`` (1, 2, ... in hash order) and ``row_total``.

    Each of 65,536 hash shards is ranked on its own; a broadcast table of at most
    65,536 shard offsets turns ranks into positions.
    """
    hashed = with_hash(rows, seed).withColumn("_shard", hash_shard(F.col(HASH)))
    counts = hashed.groupBy("_shard").agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy(F.lit(1))
    offsets = counts.select(
        "_shard",
        (F.sum("_n").over(everything.orderBy("_shard")) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(everything).alias("row_total"),
    )
    rank = F.row_number().over(Window.partitionBy("_shard").orderBy(HASH, "source", "row_key"))
    ranked = hashed.withColumn("_rank", rank).join(F.broadcast(offsets), "_shard")
    return ranked.withColumn("row_index", F.col("_rank") + F.col("_offset")).drop("_shard", "_rank", "_offset")


def split_label(row_hash_column: Column, test_share: float = TEST_SHARE) -> Column:
    """``test`` for about ``test_share`` of all hashes, else ``train``; stable when rows are added."""
    return F.when(in_share(row_hash_column, test_share), F.lit("test")).otherwise(F.lit("train"))


def split_hash(rows: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``split`` row by row: no exchange, size of the test part approximate."""
    return with_hash(rows, seed, SPLIT).withColumn("split", split_label(F.col(HASH), test_share)).drop(HASH)


def split_exact(rows: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``split`` with exactly ceil(share * rows) test rows: those first in hash order."""
    flagged = lowest_by_hash(with_hash(rows, seed, SPLIT), HASH, test_share, flag="_test")
    return flagged.withColumn("split", F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train"))).drop(
        "_test", HASH
    )
