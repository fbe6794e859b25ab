"""From a catalog to a written, split, tokenized corpus."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.batches import assign_batches, collate
from corpusloom.operators.order import HASH, shuffle_seeded, split_hash
from corpusloom.operators.tokens import Tokenizer, encode, enough_tokens, tokenize, with_mask
from corpusloom.plans.isolate import collect_sources
from corpusloom.session import new_folder
from corpusloom.sources.scan import build_corpus, stored_bytes
from corpusloom.sources.sinks import own, owned, stage, write_corpus
from corpusloom.spec import MAX_SEQ_LENGTH, MIN_TOKENS_BATCH, SEED, TEST_SHARE, SourceSpec

# Stored files are compressed; their rows take about this many times the space in a shuffle.
EXPANSION = 3
PARTITION_BYTES = 256 << 20
SUMMARY = "source string, rows long, error string, cap long"
# Readers of the corpus pass over folders with a leading underscore.
SUMMARY_FOLDER = "_summary"


def prepare_rows(
    text_rows: DataFrame,
    tokenizer: Tokenizer,
    max_length: int = MAX_SEQ_LENGTH,
    min_tokens: int = MIN_TOKENS_BATCH,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    partitions: int | None = None,
) -> DataFrame:
    """Token rows in shuffled order with their split.

    The shuffle is the only exchange. If the tokenizer can count without encoding,
    the exchange moves texts, which are smaller than their ids, and encoding runs
    in evenly filled partitions whatever the layout of the input files.
    """
    if not tokenizer.counts_cheaply:
        tokens = tokenize(text_rows, tokenizer, max_length=max_length, min_tokens=min_tokens).drop("attention_mask")
        return with_mask(_shuffled(tokens, test_share, seed, partitions))
    texts = enough_tokens(text_rows, tokenizer, max_length=max_length, min_tokens=min_tokens)
    return encode(_shuffled(texts, test_share, seed, partitions), tokenizer, max_length=max_length)


def _shuffled(rows: DataFrame, test_share: float, seed: int, partitions: int | None) -> DataFrame:
    labelled = split_hash(rows, test_share, seed)
    return shuffle_seeded(labelled, seed, partitions, within=["split"]).drop(HASH)


def batch_rows(
    text_rows: DataFrame,
    tokenizer: Tokenizer,
    batch_size: int,
    max_length: int = MAX_SEQ_LENGTH,
    min_tokens: int = MIN_TOKENS_BATCH,
    seed: int = SEED,
    drop_last: bool = True,
    mask_by_position: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Padded batches of a fixed size, straight from text rows.

    Two exchanges: one to number the rows, one to bring each batch together. Both
    move texts if the tokenizer can count without encoding. Otherwise the token rows
    are staged, because numbering reads its input twice. The second one has as many
    partitions as the rows' texts need (``measured_width``), or ``partitions``.
    """
    width = partitions or measured_width(text_rows)
    if tokenizer.counts_cheaply:
        texts = enough_tokens(text_rows, tokenizer, max_length=max_length, min_tokens=min_tokens)
        placed = assign_batches(texts, batch_size, seed, drop_last).repartition(width, "batch_id")
        tokens = encode(placed, tokenizer, max_length=max_length)
    else:
        tokens = tokenize(text_rows, tokenizer, max_length=max_length, min_tokens=min_tokens)
        tokens = stage(tokens, new_folder(tokens.sparkSession, "tokens"), "rows")
        tokens = assign_batches(tokens, batch_size, seed, drop_last).repartition(width, "batch_id")
    return collate(tokens, tokenizer.special.pad, mask_by_position)


def kept_size(text_rows: DataFrame) -> tuple[int, int]:
    """Rows and bytes of text, after all filters and caps, from one pass without an exchange of rows."""
    size = text_rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    return size[0], size[1]


def width_of(spark: SparkSession, size: int) -> int:
    """Partitions of about 256 MB of text; at least ``spark.sql.shuffle.partitions``."""
    return max(math.ceil(size / PARTITION_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))


def measured_width(text_rows: DataFrame) -> int:
    """How many partitions the kept texts need, wherever the rows come from."""
    return width_of(text_rows.sparkSession, kept_size(text_rows)[1])


def shuffle_width(spark: SparkSession, specs: Iterable[SourceSpec]) -> int:
    """Partitions of about 256 MB for the shuffle, from the size of the source files.

    At least ``spark.sql.shuffle.partitions``.
    """
    wanted = math.ceil(stored_bytes(spark, specs) * EXPANSION / PARTITION_BYTES)
    return max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))


def prepare(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    tokenizer: Tokenizer,
    path: str,
    tables: Mapping[str, DataFrame] | None = None,
    tolerant: bool = False,
    partitions: int | None = None,
    measured: bool = True,
    **options: object,
) -> DataFrame:
    """Build the corpus, prepare it and write it to ``path``; returns the written table.

    ``tolerant`` leaves out sources that cannot be opened, rendered or read to their end,
    each written apart first; otherwise these are errors. ``prepare_summary`` tells what was
    written, left out and cut. The corpus is a new version of ``path`` (``write_corpus``).

    The width of the shuffle follows the kept rows, counted in a pass of their own, so it is the
    same for sources given as ``tables``. Not ``measured``, it follows the source files without
    a pass; tables and strong filters are then sized wrong. ``partitions`` overrides both.
    """
    specs = list(specs)
    with owned(spark):
        if tolerant:
            folder = new_folder(spark, "sources")
            own(folder)
            corpus = collect_sources(spark, specs, folder, tables)
        else:
            corpus = build_corpus(spark, specs, tables)
        if partitions or not measured:
            rows, width = corpus.require_rows(), partitions or shuffle_width(spark, specs)
        else:
            rows = corpus.rows
            count, size = kept_size(rows)
            if not count:
                raise ValueError("no source gave any rows")
            width = width_of(spark, size)
        written = write_corpus(prepare_rows(rows, tokenizer, partitions=width, **options), path)
    told = [(s.name, corpus.failed.get(s.name), corpus.capped.get(s.name)) for s in specs]
    listed = spark.createDataFrame(told, "source string, error string, cap long")
    # One row per catalog source on either side.
    counts = written.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    summary = listed.join(counts, "source", "left").select("source", F.coalesce("rows", F.lit(0)).alias("rows"), "error", "cap")
    summary.coalesce(1).write.mode("overwrite").parquet(f"{path}/{SUMMARY_FOLDER}")
    return written


def prepare_summary(spark: SparkSession, path: str) -> DataFrame:
    """Of a prepared corpus: each catalog source, its written rows, why it was left out, and its cap if that left rows out."""
    return spark.read.schema(SUMMARY).parquet(f"{path}/{SUMMARY_FOLDER}")
