"""Connected components by alternating large and small stars, in joins and sums only.

No neighbourhood is gathered: each node's smallest neighbour comes from an aggregate
with partial sums, and goes back to the links by a join that Spark can split where a
node has very many links. The links of each round are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    found = both.where("b > a").join(least, "a")
    return found.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point from larger to smaller: links a node and its neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    found = links.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return found.union(least.select("a", F.col("least").alias("b"))).distinct()


def connected(links: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for every node of ``links`` (a, b).

    ``links`` are undirected pairs of longs; loops and repeated links change nothing, rows
    with a null are ignored. A root is its own node. No links give an empty table.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = staged(links.distinct(), name)
    seen = None
    while True:
        marks = links.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if tuple(marks) == seen:
            break
        seen = tuple(marks)
        links = staged(_small_star(_large_star(links)), name)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
