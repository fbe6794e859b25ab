"""Opening sources: files in any reader format, subset and split selection, fault tolerance."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.cutoff import DIRECT_ROWS
from corpusloom.operators.select import needs_total, text_rows
from corpusloom.spec import MIN_CHARS, SourceError, SourceSpec, check_catalog

log = logging.getLogger(__name__)

FEW_SPLITS = 16
TEXT_ROW = "source string, row_key string, text string"
# Reader options of a tolerant scan: skip what is damaged or gone, keep the rest.
TOLERANT = {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}


def select_part(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rows of the spec's subset and split: a filter that prunes partitions or reaches the scan."""
    for column, value in ((spec.subset_column, spec.config), (spec.split_column, spec.split)):
        if column and value is not None:
            if column not in rows.columns:
                raise SourceError(f"{spec.name}: no column {column!r} to select {value!r} by")
            rows = rows.where(F.col(f"`{column}`") == value)
    return rows


def scan(spark: SparkSession, spec: SourceSpec, tolerant: bool = False, schema: T.StructType | str | None = None) -> DataFrame:
    """Open one source. Files are read lazily; input splits give the parallelism."""
    if not spec.path:
        raise SourceError(f"{spec.name}: the spec names no path")
    reader = spark.read.format(spec.reader).options(**spec.reader_options)
    if tolerant:
        reader = reader.options(**TOLERANT)
    if schema is not None:
        reader = reader.schema(schema)
    return select_part(reader.load(spec.path), spec)


def scan_stream(
    spark: SparkSession, spec: SourceSpec, schema: T.StructType | str, max_files: int | None = None, **options: str
) -> DataFrame:
    """Open one source as a stream of arriving files; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(spec.reader).schema(schema).options(**{**spec.reader_options, **options})
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return select_part(reader.load(spec.path), spec)


def spread(rows: DataFrame) -> DataFrame:
    """Spread a scan of few splits over all cores, for CPU-bound work on small files.

    At most 16 splits (about 2 GB) are moved; larger scans have tasks enough and
    stay as they are.
    """
    splits, cores = rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if splits < min(cores, FEW_SPLITS) else rows


def stored_bytes(spark: SparkSession, specs: Iterable[SourceSpec]) -> int:
    """Size of the sources' files, from the file listing; sources without a listing count 0."""
    total = 0
    for spec in specs:
        if spec.path:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            try:
                total += files.load(spec.path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
            except AnalysisException:
                log.warning("source %s has no files to size", spec.name)
    return total


@dataclass
class Corpus:
    """Text rows of all sources that could be opened, why the others could not, and the caps that left rows out."""

    sources: list[DataFrame]
    failed: dict[str, str] = field(default_factory=dict)
    capped: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> DataFrame:
        return union_sources(self.sources)

    def require_rows(self) -> DataFrame:
        """The rows of all sources; an error if there are none. Looks for one row, source by source."""
        if all(rows.isEmpty() for rows in self.sources):
            raise ValueError("no source gave any rows")
        return self.rows


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all sources in one plan; duplicates are kept."""
    return reduce(DataFrame.unionByName, frames)


def count_scanned(sources: list[tuple[SourceSpec, DataFrame]]) -> dict[str, int]:
    """Rows of several sources, counted together in one job."""
    if not sources:
        return {}
    counts = [rows.agg(F.lit(s.name).alias("source"), F.count(F.lit(1)).alias("rows")) for s, rows in sources]
    return {r["source"]: r["rows"] for r in union_sources(counts).collect()}


# What may befall a source; anything else is a fault of the program and is raised in any case.
SOURCE_FAULTS = (SourceError, PySparkException, Py4JError)


@contextmanager
def tolerating(spec: SourceSpec, failed: dict[str, str], tolerant: bool) -> Iterator[None]:
    """Note a source's failure and go on, if asked to."""
    try:
        yield
    except SOURCE_FAULTS as error:
        if not tolerant:
            raise
        log.warning("source %s left out: %s", spec.name, error)
        failed[spec.name] = str(error)


def build_corpus(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    tables: Mapping[str, DataFrame] | None = None,
    tolerant: bool = False,
    min_chars: int = MIN_CHARS,
    direct: int = DIRECT_ROWS,
) -> Corpus:
    """Render, filter, cap and union all sources of a catalog.

    ``tables`` holds sources that are already open, by name; the others are read
    from their paths. The tasks of all sources run together as one job. When
    ``tolerant``, a source that cannot be opened, counted or rendered is reported in
    ``failed`` and left out, and damaged files are passed over (``scan_damage`` tells what
    was lost); it is an error if no source is left. A source that breaks later, while its
    rows are read, fails the job: ``plans.isolate`` keeps such sources apart.
    """
    opened, failed = {}, {}
    for spec in check_catalog(specs):
        with tolerating(spec, failed, tolerant):
            given = (tables or {}).get(spec.name)
            opened[spec] = select_part(given, spec) if given is not None else scan(spark, spec, tolerant)
    counted = [(s, rows) for s, rows in opened.items() if needs_total(rows, s)]
    totals: dict[str, int] = {}
    try:
        totals = count_scanned(counted)
    except SOURCE_FAULTS:
        if not tolerant:
            raise
        # One source broke the joint count: find out which.
        for spec, rows in counted:
            with tolerating(spec, failed, tolerant):
                totals.update(count_scanned([(spec, rows)]))
            if spec.name in failed:
                del opened[spec]
    corpus = Corpus([], failed)
    for spec, rows in opened.items():
        with tolerating(spec, failed, tolerant):
            corpus.sources.append(text_rows(rows, spec, min_chars, direct, totals.get(spec.name), corpus.capped))
    if not corpus.sources:
        raise ValueError(f"no source could be opened: {failed}")
    return corpus
