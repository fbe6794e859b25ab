"""Counts, guards and budgets."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def count_rows(rows: DataFrame, name: str = "rows") -> DataFrame:
    """The number of rows, as a one-row table."""
    return rows.agg(F.count(F.lit(1)).alias(name))


def count_split(rows: DataFrame) -> DataFrame:
    """Rows per split."""
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def observe_filter(rows: DataFrame, keep: Column, observation: Observation) -> DataFrame:
    """Filter and count scanned, kept and rejected rows in the same pass."""
    tested = F.coalesce(keep, F.lit(False))
    return rows.observe(
        observation,
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(tested).alias("kept"),
        F.count_if(~tested).alias("rejected"),
    ).where(keep)


def step_budget(
    rows: DataFrame, batch_size: int, accumulation: int, devices: int, max_steps: int
) -> DataFrame:
    """One row: effective batch, steps per pass over the train rows, passes in ``max_steps``."""
    devices = max(1, devices)
    batches = F.floor(F.col("train_rows") / (batch_size * devices))
    steps = F.greatest(F.floor(batches / accumulation), F.lit(1))
    return (
        rows.agg(F.count_if(F.col("split") == "train").alias("train_rows"))
        .withColumn("effective_batch", F.lit(batch_size * accumulation * devices).cast("long"))
        .withColumn("steps_per_epoch", steps.cast("long"))
        .withColumn("epochs", F.round(F.lit(max_steps) / F.col("steps_per_epoch"), 4))
    )


def measure(rows: DataFrame, name: str) -> dict[str, float]:
    """Run ``rows`` to the end, discard the output, and report rows, seconds and rows/s."""
    seen = Observation(f"measure_{name}")
    start = time.perf_counter()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    count = seen.get["rows"]
    return {"rows": count, "seconds": round(seconds, 4), "rows_per_second": round(count / max(seconds, 1e-9), 1)}
