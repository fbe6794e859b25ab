"""Preparing files as they arrive, with the same column expressions as in batch.

Each micro-batch is written to a folder of its own together with a history row, so
a batch that is run again replaces itself. The cap is state: it counts the rows
earlier batches wrote, as recorded in the history. A streaming ``limit`` would send
all rows through one task; here a batch is capped like a batch source.

Several sources may share one output: each has folders of its own. A source's output
belongs to one checkpoint; another one is refused.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from corpusloom.functions.render import render_text
from corpusloom.operators.cutoff import DIRECT_ROWS, cap_kept
from corpusloom.operators.order import HASH, global_index
from corpusloom.operators.select import keyed, long_enough, row_key
from corpusloom.operators.tokens import Tokenizer, with_mask
from corpusloom.session import new_folder
from corpusloom.sources.sinks import append_history, owned, read_history, stage
from corpusloom.spec import MAX_SEQ_LENGTH, MIN_CHARS, MIN_TOKENS_LAZY, SEED, SourceSpec

BATCH_RECORD = (
    "batch long, source string, rows long, rows_so_far long, timestamp timestamp, checkpoint string, "
    "scanned long, rejected long"
)


def lazy_rows(
    rows: DataFrame,
    spec: SourceSpec,
    tokenizer: Tokenizer,
    cap: int | None,
    min_chars: int = MIN_CHARS,
    min_tokens: int = MIN_TOKENS_LAZY,
    max_length: int = MAX_SEQ_LENGTH,
    direct: int = DIRECT_ROWS,
) -> DataFrame:
    """Rendered, tokenized rows of one source, capped on the rows that pass both filters."""
    rows, keys = keyed(rows, spec)
    texts = rows.select(*keys, render_text(rows, spec).alias("_text"))
    text, ids = F.col("_text"), tokenizer.ids(F.col("_text"), max_length)
    keep = long_enough(text, min_chars)
    if tokenizer.counts_cheaply:
        keep = keep & (tokenizer.count(text, max_length) >= min_tokens)
        chosen = cap_kept(texts, keys, cap, keep, direct)
        encoded = tokenizer.attach(chosen).withColumn("input_ids", ids)
    else:
        encoded = tokenizer.attach(texts.where(keep)).withColumn("input_ids", ids)
        if cap:
            # The cap reads its rows several times: encode each text only once.
            encoded = stage(encoded.drop("_text", *tokenizer.helpers), new_folder(rows.sparkSession, "encoded"), "rows")
        encoded = cap_kept(encoded, keys, cap, F.size("input_ids") >= min_tokens, direct)
    named = encoded.select(F.lit(spec.name).alias("source"), row_key(keys).alias("row_key"), "input_ids")
    return with_mask(named)


def _of(source: str) -> str:
    """The folder name of a source's stream."""
    return f"stream={quote(source, safe='')}"


def history_path(out: str, source: str) -> str:
    """Where the history rows of a source's stream lie."""
    return f"{out}/history/{_of(source)}"


def _rows_before(spark: SparkSession, out: str, batch_id: int, source: str, checkpoint: str) -> int:
    """Rows written up to the batch before, as its history row tells."""
    history = read_history(spark, history_path(out, source), BATCH_RECORD)
    if not history.where(F.col("checkpoint") != checkpoint).isEmpty():
        raise ValueError(f"{source}: {out} holds rows of another checkpoint than {checkpoint}")
    if batch_id == 0:
        return 0
    before = history.where(F.col("batch") == batch_id - 1).agg(F.max("rows_so_far")).first()[0]
    if before is None:
        raise ValueError(f"{source}: the history in {out} lacks batch {batch_id - 1}")
    return before


def _write_batch(
    rows: DataFrame, out: str, batch_id: int, source: str, before: int, checkpoint: str, scanned: int
) -> None:
    spark, path = rows.sparkSession, f"{out}/rows/{_of(source)}/batch={batch_id}"
    rows.write.mode("overwrite").parquet(path)
    written = spark.read.schema(rows.schema).parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    record = written.select(
        F.lit(batch_id).cast("long").alias("batch"), F.lit(source).alias("source"), "rows",
        (F.col("rows") + before).alias("rows_so_far"), F.current_timestamp().alias("timestamp"),
        F.lit(checkpoint).alias("checkpoint"), F.lit(scanned).cast("long").alias("scanned"),
        (F.lit(scanned) - F.col("rows")).cast("long").alias("rejected"),
    )
    append_history(record, history_path(out, source), batch_id)


def progress(spark: SparkSession, out: str) -> DataFrame:
    """Of each source and micro-batch: rows scanned, kept and rejected (by filters or the cap), and kept so far.

    Part of the batch's history row, so a batch that is run again counts once.
    """
    history = read_history(spark, f"{out}/history", BATCH_RECORD)
    return history.select("source", "batch", "scanned", F.col("rows").alias("kept"), "rejected", F.col("rows_so_far").alias("kept_so_far"))


def _run(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def start_prepare(
    stream: DataFrame, spec: SourceSpec, tokenizer: Tokenizer, out: str, checkpoint: str, **options: object
) -> StreamingQuery:
    """Prepare all files present, up to the spec's cap over all batches and restarts.

    Started again with the same ``checkpoint``, it takes up new files only.
    """
    cap = spec.stream_cap

    def handle(batch: DataFrame, batch_id: int) -> None:
        before = _rows_before(batch.sparkSession, out, batch_id, spec.name, checkpoint)
        left = None if cap is None else max(cap - before, 0)
        with owned(batch.sparkSession):
            _write_batch(lazy_rows(batch, spec, tokenizer, left, **options), out, batch_id, spec.name, before, checkpoint, batch.count())

    return _run(stream, handle, checkpoint)


def start_shuffle(stream: DataFrame, spec: SourceSpec, out: str, checkpoint: str, seed: int = SEED) -> StreamingQuery:
    """Buffered shuffle: each micro-batch is a buffer, written with its shuffled positions."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows, keys = keyed(batch, spec)
        texts = rows.select(
            F.lit(spec.name).alias("source"), row_key(keys).alias("row_key"), render_text(rows, spec).alias("text")
        )
        before = _rows_before(batch.sparkSession, out, batch_id, spec.name, checkpoint)
        _write_batch(global_index(texts, seed).drop(HASH, "row_total"), out, batch_id, spec.name, before, checkpoint, batch.count())

    return _run(stream, handle, checkpoint)


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """All rows written so far, of all sources, with the ``batch`` they came in."""
    return spark.read.parquet(f"{out}/rows").drop("stream")
