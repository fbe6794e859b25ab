"""Nearest neighbours by largest inner product, with vantage-point trees per shard.

Inner product is no metric, so vectors get one more coordinate that gives all the same
length; a query gets a zero there. Then the nearest in the metric sense is the one with
the largest inner product, and the triangle inequality holds. Each shard of the vectors
has a tree: a vantage point splits its vectors at the median distance into an inner and
an outer half. A half is skipped if, by the triangle inequality, all in it are farther
than the k-th best so far; the gap is first multiplied by ``factor``. Factor one is
exact, more skips more.

Queries go through the shards in blocks, many queries down one tree at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import staged

SHARD_ROWS = 8_192
BLOCK_ROWS = 512
# Queries that go down a tree together: a leaf is reached by a bounded number of ways, however many they are.
SEARCH_ROWS = 4_096
LEAF = 64
FACTOR = 1.15

FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part: no null, zero or empty vector, no null or non-finite component."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.where("vec_id is not null and vector is not null").where(fine & F.exists("vector", lambda x: x != 0))


class Tree:
    """A vantage-point tree over distinct points; equal vectors are one point with its smallest ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, keep: int) -> None:
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        self.begin = np.flatnonzero(new)
        # Of equal vectors no more than the ``keep`` smallest ids can be among the best.
        self.count = np.minimum(np.diff(np.append(self.begin, len(ids))), keep)
        self.ids, self.plain = ids, vectors[self.begin]
        rest = np.maximum(longest**2 - np.einsum("ij,ij->i", self.plain, self.plain), 0)
        self.points = np.concatenate([self.plain, np.sqrt(rest)[:, None]], axis=1)
        self.nodes: list[tuple] = []
        self._draw = np.random.default_rng(len(ids))
        self._build(np.arange(len(self.points)))

    def _build(self, rows: np.ndarray) -> int:
        """Number of the node over ``rows``: a leaf, or vantage point, median distance, inner, outer."""
        at = len(self.nodes)
        self.nodes.append(())
        if len(rows) > LEAF:
            vantage = rows[self._draw.integers(len(rows))]
            far = np.sqrt(((self.points[rows] - self.points[vantage]) ** 2).sum(axis=1))
            middle = float(np.median(far))
            inner, outer = rows[far <= middle], rows[far > middle]
            if len(outer):
                self.nodes[at] = (int(vantage), middle, self._build(inner), self._build(outer))
                return at
        self.nodes[at] = (rows,)
        return at

    def search(self, queries: np.ndarray, best: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The nearest ``best`` points of each query (rows, squared distances); row -1 where there are fewer."""
        q = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        rows = np.full((len(q), best), -1)
        far = np.full((len(q), best), np.inf)
        worst = np.full(len(q), np.inf)  # the farthest of each query's best so far
        lengths, own = (q**2).sum(axis=1), (self.points**2).sum(axis=1)

        def leaf(active: np.ndarray, points: np.ndarray) -> None:
            square = np.maximum(lengths[active, None] + own[points] - 2 * (q[active] @ self.points[points].T), 0)
            nearer = square.min(axis=1) < worst[active]  # most leaves have nothing for most queries
            active, square = active[nearer], square[nearer]
            if not len(active):
                return
            every = np.concatenate([far[active], square], axis=1)
            which = np.concatenate([rows[active], np.broadcast_to(points, square.shape)], axis=1)
            order = np.argpartition(every, best - 1, axis=1)[:, :best]
            far[active], rows[active] = np.take_along_axis(every, order, 1), np.take_along_axis(which, order, 1)
            worst[active] = far[active].max(axis=1)

        def visit(node: int, active: np.ndarray) -> None:
            if not len(active):
                return
            if len(self.nodes[node]) == 1:
                leaf(active, self.nodes[node][0])
                return
            vantage, middle, inner, outer = self.nodes[node]
            point = self.points[vantage]
            away = np.sqrt(np.maximum(lengths[active] + own[vantage] - 2 * (q[active] @ point), 0))
            near = away <= middle
            visit(inner, active[near])
            visit(outer, active[~near])
            reach = np.sqrt(worst[active]) * (1 + 1e-9) + 1e-9
            open_ = np.abs(away - middle) * factor <= reach
            visit(outer, active[near & open_])
            visit(inner, active[~near & open_])

        if len(self.points):
            visit(0, np.arange(len(q)))
        return rows, far

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, ...]:
        """(query id, id, inner product in double precision) of each query's ``k`` nearest in this shard, its own row left out."""
        best = max(1, min(k + 1, len(self.points)))
        rows, _ = self.search(queries, best, factor)
        at, column = np.nonzero(rows >= 0)
        row = rows[at, column]
        score = (self.plain[row] * queries[at]).sum(axis=1)
        times = self.count[row]
        inside = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        ids = self.ids[np.repeat(self.begin[row], times) + inside]
        at, score = np.repeat(at, times), np.repeat(score, times)
        other = ids != query_ids[at]
        at, ids, score = at[other], ids[other], score[other]
        order = np.lexsort((ids, -score, at))
        at, ids, score = at[order], ids[order], score[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        kept = place < k
        return query_ids[at[kept]], ids[kept], score[kept]


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, factor: float = FACTOR, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` nearest of every query: query_id, rank from 1, vec_id, score (the inner product of the original vectors).

    Queries are the rows whose vec_id is divisible by ``every``, candidates all other
    rows. Ties go to the smaller vec_id. Rows with a null vec_id, or a vector that is
    null, empty, zero or holds null or non-finite components, take no part; vectors of
    differing lengths are an error. A repeated vec_id is a candidate as often as it stands
    there, but not to a query of the same id. Other columns are left aside. An empty table, or one without queries, gives no rows.
    """
    spark = vectors.sparkSession
    rows = staged(usable(vectors), "vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    count, longest = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(norm), F.lit(0.0))).first()
    shards = max(1, -(-int(count) // shard_rows))
    hashed = F.xxhash64("vec_id", "vector")
    sharded = rows.select(F.pmod(hashed, F.lit(shards)).cast("long").alias("shard"), "vec_id", "vector")
    queries = rows.where(F.col("vec_id") % every == 0)
    asked = queries.count()
    blocks = max(1, -(-asked // BLOCK_ROWS))
    # Every block of the stated query set meets every shard once: keys are listed, not joined.
    blocked = queries.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"), F.col("vec_id"), F.col("vector")
    ).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = table.column("vec_id").to_numpy()
        values = table.column("vector").combine_chunks()
        flat = np.asarray(values.flatten() if isinstance(values, pa.Array) else values.combine_chunks().flatten(), float)
        return ids, flat.reshape(len(ids), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            tree = Tree(*matrix(left), longest, k + 1)
            ids, values = matrix(right)
            for at in range(0, len(ids), SEARCH_ROWS):
                parts.append(tree.nearest(ids[at : at + SEARCH_ROWS], values[at : at + SEARCH_ROWS], k, factor))
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, int), np.zeros(0, int), np.zeros(0)]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, (pa.int64(), pa.int64(), pa.float64()))})

    # A group holds one shard and a bounded number of query blocks.
    spread = max(1, -(-blocks // 64))
    left = sharded.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
    right = blocked.withColumn("part", F.pmod("block", F.lit(spread)))
    found = left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(run, FOUND)
    entry = F.struct((-F.col("score")).alias("away"), "vec_id")
    best = found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.away")).alias("score")
    )
