"""Packing of documents into fixed windows by deficit round-robin over source queues.

In every round each source's queue gets a quantum: its target share of one window of
tokens. A queue sends packets from its head while what it was given so far covers them,
and carries the rest, its deficit, into the next round. A packet that ends ``c`` tokens
into its queue therefore leaves in round ``ceil(c / quantum)``. That makes the scheme a
matter of running totals: within a queue to find each packet's round, and over rounds
to find its place. The rounds follow each other without a gap and are cut into windows,
so deficits carry over windows and partitions alike and no window holds padding, except
that what is left at the end goes into sequences of powers of two, also without padding.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import buckets_for, grouped, let_go, staged, texts, total_before
from corpusloom.llm.word_cache import word_encoder

WINDOW = 2_048
GRAIN = 512
GROUP = 1_000_000
# Ids that are gathered at once.
CUT_IDS = 1 << 20

TOKENS = "row_id long, doc_id long, queue string, n long, width int, ids binary"
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, source string, round long, "
    "sequence_id long, offset long, ids binary"
)


def encode_rows(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Each document's ids, ``end_id`` last, with the name of its queue (``=source``; a null source is the queue ``-``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            ids = [i + end for group in grouped(texts(batch), GROUP) for i in encoder.encode_all(group)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_id"),
                    batch.column("doc_id"),
                    batch.column("queue"),
                    pa.array([len(i) // encoder.width for i in ids], pa.int64()),
                    pa.array([encoder.width] * len(ids), pa.int32()),
                    pa.array(ids, pa.binary()),
                ],
                ["row_id", "doc_id", "queue", "n", "width", "ids"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),  # fixed once the rows are staged
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("queue"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, TOKENS)


def lay_out(
    tokens: DataFrame, window: int = WINDOW, grain: int = GRAIN, weights: Mapping[str | None, float] | None = None
) -> DataFrame:
    """Where every piece of every row goes; reads counts only, never ids.

    Returns row_id, start, length, round, sequence_id, offset. ``weights`` are target
    shares by source; a source without one, or with a weight of zero, gets the smallest
    positive share given. Without weights the target is the share that a source has of
    all tokens, so all queues last to the end. A queue that runs dry leaves its turn to the others.
    """
    if not 0 < grain <= window:
        raise ValueError("grain must be between 1 and window")
    spark = tokens.sparkSession
    sums = tokens.groupBy("queue").agg(F.sum("n").alias("queue_tokens"), F.count(F.lit(1)).alias("queue_rows"))
    all_tokens, all_rows = sums.agg(F.coalesce(F.sum("queue_tokens"), F.lit(0)), F.coalesce(F.sum("queue_rows"), F.lit(0))).first()
    total = max(int(all_tokens), 1)
    if weights:
        given = {("-" if s is None else f"={s}"): float(w) for s, w in weights.items() if w > 0}
        if not given:
            raise ValueError("no weight is positive")
        least, whole = min(given.values()), sum(given.values())
        table = spark.createDataFrame([(q, w / whole) for q, w in given.items()], "queue string, share double")
        shares = sums.join(table, "queue", "left").select("queue", F.coalesce("share", F.lit(least / whole)).alias("share"))
    else:
        shares = sums.select("queue", (F.col("queue_tokens") / F.lit(total)).alias("share"))

    rows = tokens.select("row_id", "queue", "n", F.xxhash64("row_id").alias("_order"))
    spread = buckets_for(int(all_rows), 200)
    rows = rows.withColumn("_bucket", F.pmod(F.shiftright("_order", 20), F.lit(spread)))
    rows = total_before(rows, "n", "_bucket", ["_order", "row_id"], "_ahead", group=["queue"]).join(shares, "queue")
    packets = rows.withColumn("start", F.explode(F.expr(f"sequence(0L, n - 1, {grain}L)")))
    packets = packets.withColumn("length", F.least(F.lit(grain).cast("long"), F.col("n") - F.col("start")))
    packets = packets.withColumn("_ends", F.col("_ahead") + F.col("start") + F.col("length"))
    packets = packets.withColumn("round", F.ceil(F.col("_ends") / (F.col("share") * window)).cast("long"))
    packets = packets.select("row_id", "queue", "start", "length", "round", "_ends")

    span = max(1, -(-(total // window + 1) // buckets_for(total // window + 1, 20)))
    packets = packets.withColumn("_rounds", F.floor(F.col("round") / F.lit(span)))
    packets = total_before(packets, "length", "_rounds", ["round", "queue", "_ends"], "_at")

    pieces = packets.withColumn("_from", F.explode(_cuts(F.col("_at"), F.col("_at") + F.col("length"), total, window)))
    first, number = _sequence(F.col("_from.at"), total, window)
    return pieces.select(
        "row_id",
        (F.col("start") + F.col("_from.at") - F.col("_at")).alias("start"),
        (F.col("_from.to") - F.col("_from.at")).alias("length"),
        "round",
        number.alias("sequence_id"),
        (F.col("_from.at") - first).alias("offset"),
    )


def _tail(total: int, window: int) -> list[tuple[int, int]]:
    """(begin, number) of the sequences after the last full window: powers of two, largest first."""
    begin, number, found = total // window * window, total // window, []
    for power in range(window.bit_length(), -1, -1):
        if total - begin >= 1 << power:
            found.append((begin, number))
            begin, number = begin + (1 << power), number + 1
    return found


def _cuts(begin: Column, end: Column, total: int, window: int) -> Column:
    """The parts of [begin, end) between borders of sequences; at most one border of full windows lies inside."""
    borders = F.array(begin, (F.floor(begin / window) + 1) * window, *(F.lit(b).cast("long") for b, _ in _tail(total, window)))
    inside = F.array_sort(F.array_distinct(F.filter(borders, lambda b: (b >= begin) & (b < end))))
    return F.transform(
        inside,
        lambda at, i: F.struct(at.alias("at"), F.coalesce(F.get(inside, i + 1), end).alias("to")),
    )


def _sequence(at: Column, total: int, window: int) -> tuple[Column, Column]:
    """Begin and number of the sequence that holds position ``at``."""
    number = F.floor(at / window).cast("long")
    begin = number * window
    for tail_begin, tail_number in _tail(total, window):
        later = at >= tail_begin
        number = F.when(later, F.lit(tail_number).cast("long")).otherwise(number)
        begin = F.when(later, F.lit(tail_begin).cast("long")).otherwise(begin)
    return begin, number


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    window: int = WINDOW,
    grain: int = GRAIN,
    weights: Mapping[str | None, float] | None = None,
) -> DataFrame:
    """Packs all ``docs`` (doc_id, text, source) into sequences of ``window`` tokens.

    Returns one row per piece: doc_id, start (ids of its document before it), length,
    doc_tokens, source, round, sequence_id, offset in the sequence, and the ids as
    little-endian unsigned 32-bit integers. Every id lies in exactly one piece; full
    sequences have no padding, and the last ones have sizes that are powers of two.

    Documents are cut into packets of ``grain`` tokens, so that no long document
    takes over a window. A null text is empty and has the end id alone; null and repeated
    doc_ids are kept apart by row; a null source has a queue of its own; other columns are
    left aside; an empty table gives no pieces. One document's ids are held at a time.
    """
    tokens = staged(encode_rows(docs, tokenizer, end_id), "pack-tokens")
    places = lay_out(tokens, window, grain, weights)
    fields = ["start", "length", "round", "sequence_id", "offset"]
    by_row = places.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            yield from _cut_out(batch)

    return tokens.join(by_row, "row_id").mapInArrow(run, PIECES)


def _cut_out(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The pieces of a batch of encoded rows, their ids gathered at once; a batch of very many ids is halved first."""
    count = pc.sum(batch.column("n")).as_py() or 0
    if count > CUT_IDS and batch.num_rows > 1:
        half = batch.num_rows // 2
        yield from _cut_out(batch.slice(0, half))
        yield from _cut_out(batch.slice(half))
        return
    if not batch.num_rows:
        return
    pieces, n = batch.column("pieces"), batch.column("n").to_numpy()
    parent = pc.list_parent_indices(pieces).to_numpy()
    flat = pieces.flatten()
    start, length = (flat.field(c).to_numpy() for c in ("start", "length"))
    width = batch.column("width")[0].as_py()
    whole = np.frombuffer(b"".join([x.as_buffer() for x in batch.column("ids")]), f"<u{width}")
    first = np.cumsum(n) - n
    ends = np.cumsum(length)
    at = np.arange(ends[-1]) - np.repeat(ends - length, length) + np.repeat(first[parent] + start, length)
    ids = whole[at].astype("<u4")
    rows = pa.array(parent)
    queue = batch.column("queue").take(rows)
    source = pc.if_else(pc.equal(queue, "-"), pa.scalar(None, pa.string()), pc.utf8_slice_codeunits(queue, 1))
    if len(ids) * 4 < 1 << 31:
        offsets = pa.py_buffer(np.append(0, ends * 4).astype("<i4").tobytes())
        values = pa.BinaryArray.from_buffers(pa.binary(), len(parent), [None, offsets, pa.py_buffer(ids.tobytes())])
    else:  # one very long document
        values = pa.array([ids[e - k : e].tobytes() for e, k in zip(ends.tolist(), length.tolist())], pa.binary())
    columns = {
        "doc_id": batch.column("doc_id").take(rows),
        "start": flat.field("start"),
        "length": flat.field("length"),
        "doc_tokens": batch.column("n").take(rows),
        "source": source,
        "round": flat.field("round"),
        "sequence_id": flat.field("sequence_id"),
        "offset": flat.field("offset"),
        "ids": values,
    }
    if isinstance(values, pa.ChunkedArray):
        yield from pa.table(columns).to_batches()
    else:
        yield pa.RecordBatch.from_pydict(columns)
