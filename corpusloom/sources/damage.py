"""What damaged files cost: rows that a tolerant scan loses, file by file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.sources.scan import TOLERANT
from corpusloom.spec import SourceError, SourceSpec

# Formats whose files say how many rows they hold.
COUNTED = ("parquet", "orc")


def scan_damage(spark: SparkSession, spec: SourceSpec, schema: T.StructType | str | None = None) -> DataFrame:
    """``(file, bytes, expected, read, lost, state)`` of every file of a source.

    ``expected`` is what a file's footer says, ``read`` what a tolerant scan of all columns
    gets out of it. ``state`` is ``ok``, ``rows lost``, or ``no rows`` for a file that is empty or
    has no readable footer; nobody can tell what that one lost, so ``expected`` and ``lost`` are
    null. ``schema`` is needed where the first file may have no footer. Reads the source once;
    one row per file, no row leaves the cluster.
    """
    if spec.reader not in COUNTED:
        raise SourceError(f"{spec.name}: {spec.reader} files do not tell how many rows they hold")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(spec.path)
    listing = listing.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))
    reader = spark.read.format(spec.reader).options(**{**spec.reader_options, **TOLERANT})
    rows = (reader if schema is None else reader.schema(schema)).load(spec.path)
    file = rows.metadataColumn("_metadata")["file_path"].alias("file")
    expected = rows.groupBy(file).agg(F.count(F.lit(1)).alias("expected"))
    # Spelling out every row makes the scan decode every column.
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))))
    read = rows.groupBy(file).agg(F.count(F.lit(1)).alias("read"), size.alias("_size")).where("_size >= 0").drop("_size")
    found = listing.join(expected, "file", "left").join(read, "file", "left").withColumn("read", F.coalesce("read", F.lit(0)))
    lost = F.col("expected") - F.col("read")
    state = F.when(F.col("expected").isNull(), "no rows").when(lost > 0, "rows lost").otherwise("ok")
    return found.select("file", "bytes", "expected", "read", lost.alias("lost"), state.alias("state"))
