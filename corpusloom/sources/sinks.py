"""Written tables: staged scans, the prepared corpus, run history, published snapshots.

Staged tables and history entries have folders of their own names, so a repeated write
leaves the same table. Corpora and snapshots are written to fresh folders; a row of their
manifest, written last, names the folder that holds.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from fnmatch import translate
from hashlib import sha256
from time import sleep
from urllib.parse import unquote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# The largest file that Spark reads as one value.
MAX_FILE = (1 << 31) - 1
CORPUS_MANIFEST = "sequence long, folder string, columns string"
MANIFEST = "version string, attempts int, success boolean, error string, sequence long, folder string"


def read_if_written(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The table at ``path``, or None if there is none."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


# Folders that ``stage`` and ``ScanCache`` write while an ``owned`` block is active.
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


@contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """Staged tables made inside belong to the block and are deleted at its end."""
    made: list[str] = []
    token = _owned.set(made)
    try:
        yield
    finally:
        _owned.reset(token)
        discard(spark, made)


def own(folder: str) -> None:
    """Let the enclosing ``owned`` block delete ``folder``."""
    made = _owned.get()
    if made is not None:
        made.append(folder)


def discard(spark: SparkSession, folders: Sequence[str]) -> None:
    """Delete folders through Spark's file systems; a folder that is gone already is no error."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(rows: DataFrame, folder: str, name: str, refresh: bool = False) -> DataFrame:
    """Write ``rows`` once under ``folder/name`` and read them from there from then on.

    Cuts the lineage: later jobs, and tasks re-run after a lost executor, start from
    the written files. A marker written last tells a whole table from a broken write.
    The name alone decides whether a table is there; ``ScanCache`` looks at the rows' plan and files.
    """
    spark, path = rows.sparkSession, f"{folder}/{name}"
    if refresh or read_if_written(spark, f"{path}/done") is None:
        own(path)
        rows.write.mode("overwrite").parquet(f"{path}/rows")
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/done")
    return spark.read.schema(rows.schema).parquet(f"{path}/rows")


class ScanCache:
    """Staged tables by content: rows with the same plan over unchanged files are computed once.

    The key of a table is a digest of its plan, its schema, and path, size and time of
    every file it reads; a file that is changed, added or removed gives a new key. Files
    are looked up in one distributed listing. Tables outlive the session unless their
    owner calls ``release``. Plans with Python functions may miss the cache in another session.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.used: set[str] = set()

    def key(self, rows: DataFrame) -> str:
        plan = rows._jdf.queryExecution().analyzed().canonicalized().toString()
        parts = [plan, str(rows.semanticHash()), rows.schema.json()]
        files = sorted(unquote(f) for f in rows.inputFiles())
        if files:
            found = self.spark.read.format("binaryFile").load(files)
            marks = [F.xxhash64(F.lit(i), "path", "length", "modificationTime") for i in range(2)]
            parts += map(str, found.agg(F.count(F.lit(1)), *[F.bit_xor(m) for m in marks]).first())
        return sha256("\0".join(parts).encode()).hexdigest()[:32]

    def rows(self, rows: DataFrame) -> DataFrame:
        """``rows`` as staged earlier, or staged now."""
        key = self.key(rows)
        self.used.add(key)
        return stage(rows, self.folder, key)

    def release(self) -> None:
        """Delete the tables that this cache has handed out."""
        discard(self.spark, [f"{self.folder}/{key}" for key in sorted(self.used)])
        self.used.clear()


def write_corpus(rows: DataFrame, path: str, max_rows_per_file: int = 0) -> DataFrame:
    """Write a corpus partitioned by ``split`` as the newest version of ``path`` and return it as read back.

    The version has a fresh folder and is named by the manifest once it is whole. If
    writing fails, the version before stays; who reads that one goes on undisturbed.
    """
    folder = uuid4().hex
    writer = rows.write.partitionBy("split").option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(f"{path}/versions/{folder}")
    spark = rows.sparkSession
    last = read_history(spark, f"{path}/manifest", CORPUS_MANIFEST).agg(F.max("sequence")).first()[0] or 0
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "split")
    named = spark.createDataFrame([(last + 1, folder, f"{fields}, split {rows.schema['split'].dataType.simpleString()}")], CORPUS_MANIFEST)
    append_history(named.coalesce(1), f"{path}/manifest", folder)
    return read_corpus(spark, path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of a corpus."""
    versions = read_history(spark, f"{path}/manifest", CORPUS_MANIFEST)
    newest = versions.agg(F.max(F.struct("sequence", "folder", "columns"))).first()[0]
    if newest is None:
        raise ValueError(f"no corpus in {path}")
    return spark.read.schema(newest.columns).parquet(f"{path}/versions/{newest.folder}")


def prune_corpus(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete all but the newest ``keep`` versions; only when no reader is on them."""
    versions = read_history(spark, f"{path}/manifest", CORPUS_MANIFEST)
    old = versions.orderBy(F.desc("sequence"), F.desc("folder")).offset(keep).collect()  # a row per write
    discard(spark, [f"{path}/manifest/entry={v.folder}" for v in old] + [f"{path}/versions/{v.folder}" for v in old])


def append_history(rows: DataFrame, path: str, entry: str | int) -> None:
    """Append typed history rows as one named entry; writing an entry again replaces it."""
    rows.write.mode("overwrite").parquet(f"{path}/entry={entry}")


def read_history(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All history rows with the ``entry`` they came in; empty if nothing was written."""
    fields = schema if isinstance(schema, str) else ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    history = read_if_written(spark, path, f"{fields}, entry string")
    return spark.createDataFrame([], f"{fields}, entry string") if history is None else history


def publish_snapshot(
    rows: DataFrame, root: str, version: str, exclude: Sequence[str] = (), attempts: int = 3, delay: float = 5.0
) -> bool:
    """Publish ``rows`` without the ``exclude`` columns as a version of ``root``.

    Up to ``attempts`` tries, ``delay`` seconds apart, each in a folder of its own under
    ``root/data``. The manifest row names the folder and is written after the data, so
    readers that follow the manifest never see half a version. Publishing a version again
    leaves the folder of the one before untouched; if that fails, the one before stays valid.
    """
    spark, error, success, tried = rows.sparkSession, None, False, 0
    last = read_history(spark, f"{root}/manifest", MANIFEST).agg(F.max("sequence")).first()[0]
    entry = uuid4().hex
    while tried < attempts and not success:
        tried += 1
        try:
            folder = f"{entry}-{tried}"
            rows.drop(*exclude).write.mode("overwrite").parquet(f"{root}/data/{folder}")
            success, error = True, None
        except Exception as failure:
            error = str(failure)
            log.warning("publishing %s, attempt %d of %d: %s", version, tried, attempts, error)
            if tried < attempts:
                sleep(delay)
    done = (version, tried, success, error, (last or 0) + 1, folder if success else None)
    append_history(spark.createDataFrame([done], MANIFEST).coalesce(1), f"{root}/manifest", entry)
    return success


def folder_rows(spark: SparkSession, folder: str, exclude: Sequence[str] = ()) -> DataFrame:
    """The files below ``folder`` as rows of file (path inside the folder), length, sha256 and content.

    ``exclude`` has shell patterns; a file whose name or path inside the folder matches one is not even read.
    Passed to ``publish_snapshot``, the rows are a snapshot of the folder, copied by tasks, with digests to check it
    by. Files whose names begin with ``_`` or ``.`` are hidden and left out, as Spark leaves them out anywhere;
    so are files without a byte. A file of 2 GB or more does not fit a row and is an error before anything is copied.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    files = files.withColumn("file", F.substring("path", len(root) + 2, 1 << 30))
    for pattern in exclude:
        form = "^" + translate(pattern)
        files = files.where(~F.col("file").rlike(form) & ~F.element_at(F.split("file", "/"), -1).rlike(form))
    largest = files.agg(F.max(F.struct("length", "file"))).first()[0]
    if largest is not None and largest.length > MAX_FILE:
        raise ValueError(f"{largest.file} has {largest.length} bytes, more than a row can hold")
    return files.select("file", "length", F.sha2("content", 256).alias("sha256"), "content")


def read_snapshot(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """A published version as it was last published; by default the version published last."""
    done = read_history(spark, f"{root}/manifest", MANIFEST).where("success")
    if version is not None:
        done = done.where(F.col("version") == version)
    found = done.agg(F.max_by("folder", F.struct("sequence", "folder"))).first()[0]
    if found is None:
        raise ValueError(f"no published version {version or ''} in {root}")
    return spark.read.parquet(f"{root}/data/{found}")
