"""Tables of training runs: checkpoints, metrics and publishing outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Schema of one run record.
RUN_RECORD = (
    "step long, epoch double, loss double, timestamp timestamp, "
    "model_config struct<model_name: string, hidden_size: int, num_layers: int, num_params: long>"
)
# Schema of one publishing attempt.
PUBLISH_RECORD = "step long, success boolean, timestamp timestamp, loss double"

CHECKPOINT_FILE = r"^(.*?/checkpoint-\d+)/"
CHECKPOINT_PATTERN = r"^(?:.*/)?checkpoint-(\d+)$"


def with_step(checkpoints: DataFrame, path: str = "path") -> DataFrame:
    """Add the step that a checkpoint's path names; null for other paths."""
    return checkpoints.withColumn("step", F.regexp_extract(path, CHECKPOINT_PATTERN, 1).try_cast("long"))


def list_checkpoints(spark: SparkSession, root: str) -> DataFrame:
    """``(run, path, step, files, bytes)`` of every folder ``root/<run>/checkpoint-<step>`` that holds files.

    One distributed listing through Spark's file systems; no file is opened. A folder
    without files is not a checkpoint. Paths are URLs, as Spark names files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    at = F.regexp_extract(F.col("_metadata.file_path"), CHECKPOINT_FILE, 1)
    found = files.select(at.alias("path"), "length").where("path <> ''")
    found = found.groupBy("path").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    run = F.regexp_extract("path", r"([^/]*)/checkpoint-\d+$", 1)
    return with_step(found).select(run.alias("run"), "path", "step", "files", "bytes")


def latest_checkpoint(checkpoints: DataFrame, explicit: DataFrame | None = None) -> DataFrame:
    """Per run, the explicitly chosen path if it is in the listing, else the highest step.

    ``explicit`` has one row ``(run, path)`` per run that names a path, which need not name
    a step. A run without steps and without a chosen path is left out.
    """
    if explicit is None:
        marked = checkpoints.withColumn("_chosen", F.lit(False))
    else:
        chosen = explicit.select("run", "path").withColumn("_chosen", F.lit(True))
        marked = checkpoints.join(chosen, ["run", "path"], "left")
    latest = F.coalesce(F.max(F.when(F.col("_chosen"), F.col("path"))), F.max_by("path", "step"))
    return marked.groupBy("run").agg(latest.alias("path")).where("path is not null")


def last_metric(metrics: DataFrame) -> DataFrame:
    """Loss of each run's newest entry, 0.0 where it has none."""
    return metrics.groupBy("run").agg(F.coalesce(F.max_by("loss", "step"), F.lit(0.0)).alias("loss"))


def publish_outcomes(history: DataFrame) -> DataFrame:
    """Per run: attempts, successes, last step, and whether the last step succeeded."""
    return history.groupBy("run").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if("success").alias("successes"),
        F.max("step").alias("last_step"),
        F.max_by("success", "step").alias("last_success"),
    )
