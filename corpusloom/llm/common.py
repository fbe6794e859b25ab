"""Helpers that several operators of this package use."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.position import FILE, PLACE, ROW, positioned
from corpusloom.session import new_folder

# Counts over at most this many buckets are ranked in one task; rows never are.
MAX_BUCKETS = 65_536


# Folders that ``staged`` writes while a ``recorded`` block is active.
_record: ContextVar[list[str] | None] = ContextVar("record", default=None)


def staged(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written once to a fresh folder of the shared store and read from there.

    Cuts the lineage: whatever is lost later starts again from these files.
    """
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    made = _record.get()
    if made is not None:
        made.append(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Lists the folders that are staged inside, for the caller to ``discard`` once the results are written.

    A block around it lists them as well.
    """
    made: list[str] = []
    around = _record.get()
    token = _record.set(made)
    try:
        yield made
    finally:
        _record.reset(token)
        if around is not None:
            around.extend(made)


def discard(spark: SparkSession, folders: Sequence[str]) -> None:
    """Deletes staged folders through Spark's file systems; a folder that is gone already is no error."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _read_alike(rows: DataFrame) -> bool:
    """Whether every read of a scan gives each row of each file once, and the same rows again."""
    plan = rows._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.children().size():
        plan = plan.children().apply(0)
    files = list(plan.relation().location().inputFiles())
    return len(set(files)) == len(files)


def numbered(rows: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with a long ``column`` that tells them apart and is the same at every read.

    Rows of a plain scan are told apart by the number of their file and their number in it: nothing
    is written, and first is first by file name. Others are staged under ``name`` as they are read.
    """
    placed = None if {FILE, PLACE, ROW} & set(rows.columns) else positioned(rows)
    if placed is None or not _read_alike(rows):
        return staged(rows.withColumn(column, F.monotonically_increasing_id()), name)
    files = sorted(r[0] for r in placed.select(FILE).distinct().collect())  # no column of the files is read
    numbers = rows.sparkSession.createDataFrame([(f, i) for i, f in enumerate(files)], f"{FILE} string, {column} long")
    found = placed.join(F.broadcast(numbers), FILE)
    return found.select(*rows.columns, F.shiftleft(column, 33).bitwiseOR(F.col(ROW)).alias(column))


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as make it differ from all columns."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(batch: pa.RecordBatch, column: str | int = "text") -> Iterator[str]:
    """The texts of an Arrow batch one at a time; a null counts as empty."""
    for value in batch.column(column):
        yield value.as_py() or ""


@contextmanager
def uncollected() -> Iterator[None]:
    """Python's cycle collector rests: it would walk millions of live strings and finds no cycles here."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def grouped(values: Iterator[str], characters: int) -> Iterator[list[str]]:
    """Lists of texts of about so many characters together; a longer text comes alone."""
    group, held = [], 0
    for value in values:
        if group and held + len(value) > characters:
            yield group
            group, held = [], 0
        group.append(value)
        held += len(value)
    if group:
        yield group


_held: dict[object, object] = {}


def held(key: object, make: Callable[[], object]) -> object:
    """What ``make`` builds, kept by the worker process for its next tasks; one thing at a time.

    A worker that turns to other work lets go of what it held, and gives the memory back to the system.
    """
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """To be called by tasks that need nothing of what their worker may hold."""
    if _held:
        _held.clear()
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def give_back() -> None:
    """Gives memory that a worker has freed back to the system; its next tasks may be of another kind."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def buckets_for(rows: int, per_bucket: int) -> int:
    """How many buckets keep about ``per_bucket`` rows each, within 1..65,536."""
    return max(1, min(MAX_BUCKETS, rows // per_bucket + 1))


def total_before(
    rows: DataFrame, value: str, bucket: str, order: Sequence[str], out: str, group: Sequence[str] = ()
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all earlier rows of the group.

    Rows are ordered by ``bucket``, then by ``order``. Sums of the buckets (at most
    65,536 a group) give each bucket its start; inside a bucket a window goes on. No
    task sees more than one bucket at a time, however large a group is.
    """
    keys = [*group, bucket]
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    starts = starts.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.join(starts, keys).withColumn(out, F.col("_start") + F.col("_inside")).drop("_start", "_inside")


class Memory(dict):
    """A bounded memory of computed values, in two generations.

    When ``limit`` new entries are held, they become the old generation and the one
    before is forgotten; entries that are asked for again move on. So frequent keys stay.
    """

    def __init__(self, limit: int) -> None:
        super().__init__()
        self.limit, self.old = limit, {}

    def missing(self, keys: set) -> list:
        """The keys that must be computed; old ones are taken over."""
        old, lost = self.old, []
        for key in keys.difference(self):
            value = old.get(key)
            if value is None:
                lost.append(key)
            else:
                self[key] = value
        return lost

    def turn(self) -> None:
        """To be called when no lookup is under way."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
