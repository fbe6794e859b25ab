"""Exact "first n rows" without ranking a whole source in one task.

A cap becomes a threshold: find the n-th smallest key, then keep rows up to it.
The final read is a plain filter, pushed into the file scan, and text columns are
read for the kept key range only.

The threshold is found while the plan is built, by narrowing a key range with sampled
pivots, whatever n is. Each step is a key-only aggregate; the driver sees some ten
thousand sampled keys and counts, never the rows, and only a range of so few keys is sorted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.hashing import hash_shard

# A key range of up to this many rows is sorted as it is.
DIRECT_ROWS = 10_000
# Fewest keys to sample per narrowing step; usually as many as DIRECT_ROWS.
MIN_PIVOTS = 500


def _key(name: str) -> Column:
    return F.col(f"`{name}`")


def _columns(keys: Sequence[str]) -> list[Column]:
    return [_key(k).alias(k) for k in keys]


def _repeated(keys: Sequence[str]) -> str:
    return f"key columns {list(keys)} do not identify rows; leave them empty to key by content"


def _up_to(keys: Sequence[str], bound: Row, schema: T.StructType) -> Column:
    """Rows whose key is at most ``bound``. Null keys sort first, as in ``orderBy``."""
    limits = [F.lit(bound[i]).cast(schema[k].dataType) for i, k in enumerate(keys)]
    # The first key alone is a filter that file scans can use.
    leading = _key(keys[0]).isNull()
    if bound[0] is not None:
        leading = leading | (_key(keys[0]) <= limits[0])
    if len(keys) == 1:
        return leading
    return leading & (F.struct(*_columns(keys)) <= F.struct(*[v.alias(k) for k, v in zip(keys, limits)]))


def _sample(window: DataFrame, keys: Sequence[str], total: int, pivots: int, salt: int) -> list[Row]:
    """About ``pivots`` keys, sorted.

    Which keys are sampled depends on their hash, so a retried task picks the same ones.
    """
    step = max(1, total // pivots)
    chosen = F.pmod(F.xxhash64(*_columns(keys), F.lit(salt)), F.lit(step)) == 0
    return window.where(chosen).distinct().orderBy(*_columns(keys)).collect()


def nth_key(
    rows: DataFrame, keys: Sequence[str], n: int, direct: int = DIRECT_ROWS, total: int | None = None
) -> Row | None:
    """The n-th smallest key, or None if there are no more than n rows.

    Keys must be unique: it is an error if more than n rows have a key up to the n-th.
    ``total`` is the number of rows, where it is known already.
    """
    window = rows.select(*_columns(keys))
    schema = window.schema
    rank, salt, stalled = n, 0, 0
    total = window.count() if total is None else total
    if total <= n:
        return None
    # A range of so few keys is sorted as it is.
    few = max(direct, MIN_PIVOTS)
    while total > few:
        salt, before = salt + 1, total
        pivots = _sample(window, keys, total, few, salt)
        if not pivots:
            # Another salt picks other keys, unless all rows have one of a few keys.
            stalled += 1
            if stalled == 5:
                raise ValueError(_repeated(keys))
            continue
        slack = 4 * math.sqrt(len(pivots))
        place = rank / total * len(pivots)
        low, high = math.floor(place - slack), math.ceil(place + slack)
        tests = [
            F.count_if(_up_to(keys, pivots[i], schema)) if 0 <= i < len(pivots) else F.lit(None)
            for i in (low, high)
        ]
        below, through = window.agg(*[t.alias(a) for t, a in zip(tests, ("below", "through"))]).first()
        if low >= 0 and below < rank:
            window = window.where(~_up_to(keys, pivots[low], schema))
            rank -= below
            total -= below
            through = None if through is None else through - below
        elif low >= 0:
            high, through = low, below
        if high < len(pivots) and through >= rank:
            window = window.where(_up_to(keys, pivots[high], schema))
            total = through
        stalled = stalled + 1 if total == before else 0
        if stalled == 5:
            raise ValueError(_repeated(keys))
    if rank <= total - rank:
        edge = window.orderBy(*_columns(keys)).limit(rank)
        best = edge.agg(F.max(F.struct(*_columns(keys))).alias("bound")).first()
    else:
        # Closer to the top of the range: the same key, counted from the other end.
        edge = window.orderBy(*[_key(k).desc() for k in keys]).limit(total - rank + 1)
        best = edge.agg(F.min(F.struct(*_columns(keys))).alias("bound")).first()
    if window.where(_up_to(keys, best["bound"], schema)).count() != rank:
        raise ValueError(_repeated(keys))
    return best["bound"]


def cap_scanned(
    rows: DataFrame,
    keys: Sequence[str],
    n: int | None,
    direct: int = DIRECT_ROWS,
    total: int | None = None,
    on_bind: Callable[[], None] | None = None,
) -> DataFrame:
    """The first ``n`` rows by key; ``None`` keeps all rows. ``on_bind`` is called if rows are left out."""
    if n is None:
        return rows
    if n <= 0:
        return _none_of(rows, on_bind)
    return _cut(rows, keys, nth_key(rows, keys, n, direct, total), on_bind)


def cap_kept(
    rows: DataFrame,
    keys: Sequence[str],
    n: int | None,
    keep: Column,
    direct: int = DIRECT_ROWS,
    total: int | None = None,
    on_bind: Callable[[], None] | None = None,
) -> DataFrame:
    """The first ``n`` rows by key among those that satisfy ``keep``. ``on_bind`` is called if rows are left out.

    Only a growing head of the source is tested against ``keep``, as an early stop
    would: twice ``n`` rows first, more if too few pass.
    """
    kept = rows.where(keep)
    if n is None:
        return kept
    if n <= 0:
        return _none_of(rows, on_bind)
    total = rows.count() if total is None else total
    if total <= n:
        return kept
    few = max(direct, MIN_PIVOTS)
    if total <= few:
        return _cut(kept, keys, nth_key(kept, keys, n, direct), on_bind)
    key_rows = rows.select(*_columns(keys))
    schema = key_rows.schema
    pivots = _sample(key_rows, keys, total, few, salt=0)
    reach = 2 * n
    while True:
        # A head of about ``reach`` rows; any head with enough rows that pass will do.
        edge = math.ceil(reach / total * len(pivots))
        if edge >= len(pivots):
            return _cut(kept, keys, nth_key(kept, keys, n, direct), on_bind)
        head = rows.where(_up_to(keys, pivots[edge], schema)).where(keep)
        passed = head.count()
        if passed > n:
            return _cut(kept, keys, nth_key(head, keys, n, direct, passed), on_bind)
        reach *= max(2, math.ceil(1.25 * n / max(passed, 1)))


def _none_of(rows: DataFrame, on_bind: Callable[[], None] | None) -> DataFrame:
    if on_bind:
        on_bind()
    return rows.where(F.lit(False))


def _cut(rows: DataFrame, keys: Sequence[str], bound: Row | None, on_bind: Callable[[], None] | None) -> DataFrame:
    if bound is None:
        return rows
    if on_bind:
        on_bind()
    return rows.where(_up_to(keys, bound, rows.select(*_columns(keys)).schema))


# JSON that tells all values of a row apart; by default it cuts timestamps to milliseconds.
LOSSLESS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def content_key(rows: DataFrame, chunk: int = 100_000) -> DataFrame:
    """Give rows without a key one: ``content_key`` (hash of all columns) and ``copy_no``.

    Equal rows are interchangeable, so they are counted first (partial aggregation
    absorbs any hot value) and written out again as numbered copies. Only groups of
    more than ``chunk`` copies are spread over tasks, a chunk at a time.
    """
    columns = [_key(c) for c in rows.columns]
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    whole_row = F.to_json(F.struct(*columns), LOSSLESS)
    counted = counted.withColumn("content_key", F.md5(whole_row))

    def numbered(groups: DataFrame, start: Column, end: Column) -> DataFrame:
        return groups.select(*columns, "content_key", F.explode(F.sequence(start, end)).alias("copy_no"))

    few = counted.where(F.col("copies") <= chunk)
    many = counted.where(F.col("copies") > chunk)
    starts = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(chunk).cast("long"))
    chunks = many.withColumn("start", F.explode(starts)).repartition("content_key", "start")
    last = F.least(F.col("start") + chunk, F.col("copies")) - 1
    return numbered(few, F.lit(0).cast("long"), F.col("copies") - 1).unionByName(
        numbered(chunks, F.col("start"), last)
    )


def lowest_by_hash(
    rows: DataFrame, row_hash: str, quota: DataFrame | float, groups: Sequence[str] = (), flag: str = "chosen"
) -> DataFrame:
    """Flag exactly the rows with the smallest hashes, per group.

    ``quota`` is a share of the rows (rounded up), or a table ``groups + quota``.
    Groups must be few (catalog sources), and hashes unique within a group. Rows
    are counted per hash shard, and only the one shard per group that holds the cut
    is ranked: no task ranks more than 1/65,536 of a group, and ``rows`` itself is
    not shuffled.
    """
    by = list(groups) or ["_all"]
    whole = Window.partitionBy(*by)
    slim = rows.select(*([_key(g) for g in groups] or [F.lit(0).alias("_all")]), _key(row_hash).alias("_h"))
    slim = slim.withColumn("_shard", hash_shard(F.col("_h")))
    counts = slim.groupBy(*by, "_shard").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(
        "*", F.sum("_n").over(whole.orderBy("_shard")).alias("_upto"), F.sum("_n").over(whole).alias("_total")
    )
    if isinstance(quota, DataFrame):
        # One row per catalog source.
        counts = counts.join(F.broadcast(quota.select(*groups, F.col("quota").alias("_quota"))), by)
    else:
        counts = counts.withColumn("_quota", F.ceil(F.col("_total") * F.lit(float(quota))).cast("long"))
    rank = F.least("_quota", "_total")
    before = F.col("_upto") - F.col("_n")
    edge = counts.where((F.col("_upto") >= rank) & (before < rank)).select(*by, "_shard", (rank - before).alias("_need"))
    # One shard per group.
    ranked = slim.join(F.broadcast(edge), [*by, "_shard"])
    ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy(*by, "_shard").orderBy("_h")))
    cuts = ranked.where(F.col("_rank") == F.col("_need")).select(*by, F.col("_h").alias("_cut"))
    if groups:
        # One row per group.
        rows, cut = rows.join(F.broadcast(cuts), by, "left"), F.col("_cut")
    else:
        cut = cuts.select("_cut").scalar()
    # A group without a quota has no cut, and none of its rows are chosen.
    return rows.withColumn(flag, F.coalesce(_key(row_hash) <= cut, F.lit(False))).drop("_cut")
