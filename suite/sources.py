"""Virtual sources: the test tables in the shape of a training-text catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources import scan
from corpusloom.spec import SourceSpec

ANSWER_TAG, BOX_TAG = " #### ", " \\boxed{"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog() -> list[SourceSpec]:
    """Eight sources with the kinds, categories and caps of the default mix."""
    pair = {"text_field": "question", "answer_field": "answer", "format": "reasoning", "category": "reasoning",
            "key_columns": ("conv_id", "turn")}
    return [
        SourceSpec("web_en", config="en", subset_column="lang", weight=0.20, streaming=True, max_samples=500_000,
                   key_columns=("doc_id",)),
        SourceSpec("web_de", config="de", subset_column="lang", weight=0.10, max_samples=300_000,
                   key_columns=("doc_id",)),
        SourceSpec("code", text_field="html", weight=0.10, streaming=True, max_samples=300_000, category="code",
                   key_columns=("page_id",)),
        SourceSpec("gsm", weight=0.08, max_samples=50_000, **pair),
        SourceSpec("boxed", weight=0.10, streaming=True, max_samples=300_000, **pair),
        SourceSpec("orca", weight=0.12, streaming=True, max_samples=400_000, system_field="system_prompt", **pair),
        SourceSpec("chat", text_field="messages", weight=0.05, max_samples=100_000, category="instructions",
                   key_columns=("conv_id",)),
        SourceSpec("qa", answer_field="item_id", weight=0.05, max_samples=None, category="instructions",
                   key_columns=("item_id",)),
    ]


def spec(name: str) -> SourceSpec:
    return next(s for s in catalog() if s.name == name)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def pairs(talk: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it, keyed by the user turn.

    The join is on the unique pair (conversation, turn), so one huge conversation
    spreads over all tasks.
    """
    asked = talk.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    replied = talk.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(replied, ["conv_id", "turn"])


def gsm(talk: DataFrame) -> DataFrame:
    tag = F.concat(F.lit(ANSWER_TAG), F.col("turn").cast("string"))
    return pairs(talk).withColumn("answer", F.concat("answer", tag))


def boxed(talk: DataFrame) -> DataFrame:
    tag = F.concat(F.lit(BOX_TAG), F.col("turn").cast("string"), F.lit("}"))
    return pairs(talk).withColumn("answer", F.concat("answer", tag))


def orca(talk: DataFrame) -> DataFrame:
    system = talk.where("role = 'system'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("system_prompt"))
    return pairs(talk).join(system, "conv_id", "left")


def chat(talk: DataFrame) -> DataFrame:
    """One row per conversation. A conversation is one training text, so it is one row."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return talk.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", messages.alias("messages"))


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    documents, talk = table(spark, sf_dir, "documents"), conversations(spark, sf_dir)
    return {
        "web_en": documents,
        "web_de": documents,
        "code": table(spark, sf_dir, "pages"),
        "gsm": gsm(talk),
        "boxed": boxed(talk),
        "orca": orca(talk),
        "chat": chat(talk),
        "qa": table(spark, sf_dir, "benchmark"),
    }


def document_rows(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """All documents as text rows; ``spread`` for CPU-bound work on them."""
    documents = table(spark, sf_dir, "documents")
    rows = documents.select("source", F.col("doc_id").cast("string").alias("row_key"), "text")
    return scan.spread(rows) if spread else rows


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of training steps: one run per user."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        F.col("value").alias("loss"),
        F.col("ts").alias("timestamp"),
        (F.col("event_type") != "error").alias("success"),
        "event_type",
    )
