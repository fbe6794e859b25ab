"""Row filters and the step from a raw source to its text rows."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.render import render_text
from corpusloom.functions.text import stripped_length
from corpusloom.operators.cutoff import DIRECT_ROWS, cap_kept, cap_scanned, content_key
from corpusloom.operators.position import PLACE, ROW, cap_by_position, positioned
from corpusloom.session import new_folder
from corpusloom.sources.sinks import stage
from corpusloom.spec import MIN_CHARS, SourceError, SourceSpec

log = logging.getLogger(__name__)


def long_enough(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """At least ``min_chars`` characters, not counting outer whitespace."""
    return stripped_length(text) >= min_chars


def every_nth(rows: DataFrame, step: str, n: int) -> DataFrame:
    """Keep the rows of a metrics table whose step is a multiple of ``n``."""
    return rows.where(F.col(step) % n == 0)


def row_key(keys: tuple[str, ...]) -> Column:
    """The key columns as one string; different keys give different strings.

    Parts are joined by ``:``. A backslash escapes one in a part, and itself; ``\\N`` is null.
    """
    parts = [F.col(f"`{k}`").cast("string") for k in keys]
    escaped = [F.replace(F.replace(p, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:")) for p in parts]
    return F.concat_ws(":", *[F.coalesce(e, F.lit("\\N")) for e in escaped])


def keyed(rows: DataFrame, spec: SourceSpec) -> tuple[DataFrame, tuple[str, ...]]:
    """Rows with key columns; tables without a key are keyed by content."""
    if spec.key_columns:
        missing = [k for k in spec.key_columns if k not in rows.columns]
        if missing:
            raise SourceError(f"{spec.name}: key columns not found: {missing}")
        return rows, spec.key_columns
    return content_key(rows), ("content_key", "copy_no")


def needs_total(rows: DataFrame, spec: SourceSpec) -> bool:
    """Whether the cap of a source starts from the number of its rows."""
    return bool(spec.batch_cap) and (bool(spec.key_columns) or positioned(rows, spec.path) is None)


def text_rows(
    rows: DataFrame,
    spec: SourceSpec,
    min_chars: int = MIN_CHARS,
    direct: int = DIRECT_ROWS,
    total: int | None = None,
    bound: dict[str, int] | None = None,
) -> DataFrame:
    """``(source, row_key, text)`` of one source: rendered, filtered and capped.

    A lazy source caps the rows it keeps; a batch source caps the rows it scans. Rows
    without a key are told apart by file and row number where the files number their
    rows, else by content. ``total`` is the number of rows, where it is known already.
    A cap that leaves rows out is logged, and noted in ``bound`` by the source's name.
    """
    cap = spec.batch_cap

    def on_bind() -> None:
        log.warning("source %s is cut at its cap of %d rows", spec.name, cap)
        if bound is not None:
            bound[spec.name] = cap

    text = render_text(rows, spec)
    keep = long_enough(text, min_chars)
    placed = None if spec.key_columns else positioned(rows, spec.path)
    if placed is not None:
        keys = (PLACE, ROW)
        capped = cap_by_position(placed, cap, keep if spec.streaming else None, direct, on_bind)
    else:
        if cap and total is None:
            total = rows.count()
        rows, keys = keyed(rows, spec)
        if cap and total > cap and not spec.key_columns:
            # The cap reads the keys several times: group equal rows only once.
            rows = stage(rows, new_folder(rows.sparkSession, "keyed"), "rows")
        if spec.streaming:
            capped = cap_kept(rows, keys, cap, keep, direct, total, on_bind)
        else:
            capped = cap_scanned(rows, keys, cap, direct, total, on_bind)
    kept = capped if spec.streaming else capped.where(keep)
    return kept.select(F.lit(spec.name).alias("source"), row_key(keys).alias("row_key"), text.alias("text"))


def latest_n(rows: DataFrame, by: str, step: str, n: int) -> DataFrame:
    """The ``n`` highest steps of each run.

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000,000 in the recommended
    session), the rank limit is applied before the exchange as well, so a run with very
    many rows sends at most ``n`` of them per task.
    """
    ranked = Window.partitionBy(by).orderBy(F.col(step).desc())
    return rows.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= n).drop("_rank")
