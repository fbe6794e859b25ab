"""Weighted mixture of sources and the report on it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.cutoff import lowest_by_hash
from corpusloom.operators.order import HASH, with_hash
from corpusloom.spec import DECLARED_SHARES, SEED, SourceSpec

MIXTURE = "mixture"


def catalog_table(spark: SparkSession, specs: Iterable[SourceSpec]) -> DataFrame:
    """Name, category and weight of each source: one row per catalog entry."""
    rows = [(s.name, s.category, float(s.weight)) for s in specs]
    return spark.createDataFrame(rows, "source string, category string, weight double")


def count_per_source(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows per catalog source; a source without rows shows 0."""
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    # Only catalog sources are kept, so either broadcast side has one row per catalog entry.
    known = counts.join(F.broadcast(catalog.select("source")), "source")
    listed = catalog.select("source").join(F.broadcast(known), "source", "left")
    return listed.select("source", F.coalesce("rows", F.lit(0)).alias("rows"))


def quotas(specs: Iterable[SourceSpec], budget: int) -> dict[str, int]:
    """Rows per source for a total budget, in proportion to the weights."""
    specs = list(specs)
    total = sum(s.weight for s in specs)
    if total <= 0:
        raise ValueError("the weights of a mixture must not all be zero")
    return {s.name: int(budget * s.weight / total + 0.5) for s in specs}


def mixture(rows: DataFrame, specs: Iterable[SourceSpec], budget: int, seed: int = SEED) -> DataFrame:
    """Per source, the rows first in the mixture's hash order up to its quota (all, if it has fewer)."""
    wanted = rows.sparkSession.createDataFrame(list(quotas(specs, budget).items()), "source string, quota long")
    flagged = lowest_by_hash(with_hash(rows, seed, MIXTURE), HASH, wanted, groups=["source"], flag="_chosen")
    return flagged.where("_chosen").drop("_chosen", HASH)


def mixture_report(
    rows: DataFrame, specs: Iterable[SourceSpec], declared: Mapping[str, float] = DECLARED_SHARES
) -> DataFrame:
    """Rows and share per category: observed, by catalog weight, and as declared."""
    spark = rows.sparkSession
    catalog = catalog_table(spark, specs)
    shares = spark.createDataFrame([(k, float(v)) for k, v in declared.items()], "category string, declared_share double")
    per_source = catalog.join(F.broadcast(count_per_source(rows, catalog)), "source")
    total = per_source.agg(F.sum("rows")).scalar()
    weights = catalog.agg(F.sum("weight")).scalar()
    report = per_source.groupBy("category").agg(
        F.count(F.lit(1)).alias("sources"),
        F.sum("rows").alias("rows"),
        F.round(F.sum("weight") / weights, 6).alias("weight_share"),
    )
    report = report.withColumn("observed_share", F.round(F.col("rows") / total, 6))
    return report.join(F.broadcast(shares), "category", "left")
