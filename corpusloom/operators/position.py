"""Caps of sources without a key: rows are told apart, and counted, by file and row number.

File formats that number their rows need neither a key nor a look at the contents: rows are
ordered by file name and row number, and "the first n" are whole leading files and the head
of one more. The result is a filter on those two columns. Spark prunes the file list by it,
so later files are never opened, and there is no exchange in the capped scan.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.cutoff import DIRECT_ROWS, nth_key

# The file as its reader names it, its name within the source, and the row's number in it.
ONE_TO_ONE = ("LogicalRelation", "Project", "Filter", "SubqueryAlias")
FILE, PLACE, ROW = "_source_file", "_source_place", "_source_row"


def _listed(rows: DataFrame) -> list[str]:
    """The files of a scan in the spelling and order of the file column, from the listing the driver has."""
    return sorted(name.replace("file:///", "file:/", 1) for name in rows.inputFiles())


def _root(files: list[str], path: str | None) -> str:
    """What all file names start with: up to the source's path if they show it, else their common folder."""
    folder = f"{quote(path.rstrip('/'))}/" if path else ""
    if folder and folder in files[0]:
        return files[0][: files[0].index(folder) + len(folder)]
    return os.path.commonprefix([*files, files[0].rpartition("/")[0] + "/"]).rpartition("/")[0] + "/"


def _plain(plan: object) -> bool:
    """Whether a plan only reads files, filters and selects: each of its rows is one row of a file."""
    below = plan.children()
    return plan.nodeName() in ONE_TO_ONE and all(_plain(below.apply(i)) for i in range(below.size()))


def positioned(rows: DataFrame, path: str | None = None) -> DataFrame | None:
    """``rows`` with their file, place and row number; None unless they are a plain scan of numbered files.

    ``path`` is the folder of the source: places are file names below it, so they
    stay the same when the whole folder moves.
    """
    if not _plain(rows._jdf.queryExecution().analyzed()):
        return None
    try:
        at = rows.metadataColumn("_metadata")
        placed = rows.select("*", at["file_path"].alias(FILE), at["row_index"].alias(ROW))
        placed.schema  # noqa: B018  resolves the columns
    except AnalysisException:
        return None
    files = _listed(rows)
    if not files:
        return None
    root = _root(files, path)
    inside = F.when(F.startswith(FILE, F.lit(root)), F.substring(FILE, len(root) + 1, 1 << 20)).otherwise(F.col(FILE))
    return placed.withColumn(PLACE, inside)


def cap_by_position(
    rows: DataFrame,
    n: int | None,
    keep: Column | None = None,
    direct: int = DIRECT_ROWS,
    on_bind: Callable[[], None] | None = None,
) -> DataFrame:
    """The first ``n`` of ``rows`` (from ``positioned``), or of those that satisfy ``keep``; None keeps all.

    Leading files are counted in growing steps until they hold ``n`` rows; without
    ``keep`` and other filters a count reads file footers only. The driver sees a count
    for each of those files. ``on_bind`` is called if rows are left out.
    """
    tested = rows if keep is None else rows.where(keep)
    if n is None:
        return tested
    if n <= 0:
        if on_bind:
            on_bind()
        return rows.where(F.lit(False))
    files, seen, low = _listed(rows), 0, None
    reach = step = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    while True:
        # The last step has no upper edge, so every file is in one step.
        high = files[reach - 1] if reach < len(files) else None
        part = tested if low is None else tested.where(F.col(FILE) > low)
        part = part if high is None else part.where(F.col(FILE) <= high)
        counts = part.groupBy(FILE).count().collect()
        for name, count in sorted(counts):
            if seen + count >= n:
                return _up_to(rows, tested, name, count, n - seen, direct, on_bind)
            seen += count
        if high is None:
            return tested
        low, step = high, 2 * step
        reach += step


def _up_to(
    rows: DataFrame, tested: DataFrame, name: str, count: int, need: int, direct: int, on_bind: Callable[[], None] | None
) -> DataFrame:
    """The rows of all files before ``name`` and the first ``need`` of its ``count``."""
    capped = tested.where(F.col(FILE) <= name)
    if need < count:
        last = nth_key(tested.where(F.col(FILE) == name), [ROW], need, direct, count)[ROW]
        capped = capped.where((F.col(FILE) < name) | (F.col(ROW) <= last))
    if on_bind and (need < count or not tested.where(F.col(FILE) > name).isEmpty()):
        on_bind()
    return capped
