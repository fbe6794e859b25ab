"""Sources kept apart: one that breaks while it is read costs its own rows only.

Each source is a job of its own that writes its text rows to a fresh folder. A manifest
of the sources that finished, and of why the others did not, is written last and unites
them. A run that ends before has left no manifest, and the run before stays valid.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from urllib.parse import quote
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.cutoff import DIRECT_ROWS
from corpusloom.sources.scan import SOURCE_FAULTS, TEXT_ROW, Corpus, build_corpus, log
from corpusloom.sources.sinks import append_history, read_history
from corpusloom.spec import MIN_CHARS, SourceSpec, check_catalog

MANIFEST = "sequence long, source string, folder string, rows long, error string, cap long"
# Sources that are written at the same time; the tasks of each share the cluster.
AT_ONCE = 4


def collect_sources(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    folder: str,
    tables: Mapping[str, DataFrame] | None = None,
    min_chars: int = MIN_CHARS,
    direct: int = DIRECT_ROWS,
) -> Corpus:
    """Write the text rows of each source under ``folder`` and unite those that finished.

    A source fails as a whole: what was read of it before is not used. It is an error if
    none finishes.
    """
    specs, run = check_catalog(specs), uuid4().hex

    def write(spec: SourceSpec) -> tuple[str, str | None, int, str | None, int | None]:
        path, seen = f"{folder}/rows/{run}/{quote(spec.name, safe='')}", Observation()
        try:
            corpus = build_corpus(spark, [spec], tables, min_chars=min_chars, direct=direct)
            corpus.rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        except SOURCE_FAULTS as error:
            log.warning("source %s left out: %s", spec.name, error)
            return spec.name, None, 0, str(error), None
        return spec.name, path, seen.get["rows"], None, corpus.capped.get(spec.name)

    target = inheritable_thread_target(spark)(write)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        # Each thread has the caller's context, so that an ``owned`` block sees what is staged there.
        outcomes = [f.result() for f in [pool.submit(copy_context().run, target, spec) for spec in specs]]
    if all(path is None for _, path, *_ in outcomes):
        raise ValueError(f"no source could be read: { {name: error for name, _, _, error, _ in outcomes} }")
    last = read_history(spark, f"{folder}/manifest", MANIFEST).agg(F.max("sequence")).first()[0] or 0
    manifest = spark.createDataFrame([(last + 1, *outcome) for outcome in outcomes], MANIFEST)
    append_history(manifest.coalesce(1), f"{folder}/manifest", run)
    return read_sources(spark, folder)


def source_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``(source, folder, rows, error, cap)`` of the last whole run: a row per source of the catalog."""
    runs = read_history(spark, f"{folder}/manifest", MANIFEST)
    last = runs.agg(F.max(F.struct("sequence", "entry"))).first()[0]
    if last is None:
        raise ValueError(f"no run has finished in {folder}")
    return runs.where(F.col("entry") == last.entry).drop("sequence", "entry")


def read_sources(spark: SparkSession, folder: str) -> Corpus:
    """The corpus of the last whole run in ``folder``."""
    corpus = Corpus([])
    for source in source_manifest(spark, folder).orderBy("source").collect():  # one row per catalog source
        if source.folder is None:
            corpus.failed[source.source] = source.error
            continue
        corpus.sources.append(spark.read.schema(TEXT_ROW).parquet(source.folder))
        if source.cap is not None:
            corpus.capped[source.source] = source.cap
    return corpus
