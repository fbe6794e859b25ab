"""A training corpus from the documents table: five stages, each on all that its predecessor kept.

A stage takes a table with the columns of documents, in any order and with others beside them, which it leaves
aside; all stages but the last return these columns. A null text counts as empty or is
passed on, a null doc_id is a row like any other, repeated rows are documents of their own, texts
may have any length, and an empty table gives an empty one. What a stage called by itself stages stays in the
shared folder as long as its result may be read; ``run`` deletes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import lang_crf, mixture_pack, secrets, sentence_dedup, simhash
from corpusloom.llm.common import discard, recorded, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.35
TOKENIZER = "word_bpe_49k.json"

# SQL cannot express these stages; the tests compare each with a brute-force version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language (no letters, or a mean probability below LEAST_SCORE); ``lang`` becomes the predicted one."""
    found = lang_crf.identify(docs.select(*COLUMNS))
    kept = found.where((F.col("lang_pred") != lang_crf.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by three-word SimHash at two bits or fewer."""
    return simhash.keep_one(docs.select(*COLUMNS), shingle=3, distance=2)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes sentences of repeated spans but for their first place; documents stay, with what is left of their text."""
    found = sentence_dedup.remove_repeats(docs.select(*COLUMNS))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every found secret by a mark; documents stay."""
    found = secrets.scan(docs.select(*COLUMNS)).withColumn("text", F.col("redacted"))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into windows of 2048 tokens, by the token shares of their sources."""
    return mixture_pack.pack_documents(docs, public_tokenizers.path(TOKENIZER), end_id=1)


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("repeated spans", drop_repeated_spans),
    ("secrets", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written as Parquet and read again.

    A run owns the folders it makes: a stage's scratch tables go once its result is
    written, a result once the next one is. The last result stays, for the caller to read.
    """
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with recorded() as scratch:
            found = stage(spark, docs, sf_dir)
        with recorded() as result:
            docs = staged(found, f"pipeline-{name.replace(' ', '-')}")
        discard(spark, [*scratch, *written])
        written = result
    return docs
