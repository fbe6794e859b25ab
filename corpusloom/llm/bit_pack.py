"""Token files: ids at a fixed width of as few bits as the vocabulary needs.

A file row is one block of whole documents:

    shard        number of the range of doc_ids; shards and blocks ascend with doc_id
    block        number of the block within its shard
    first        ids of the shard before this block
    least_id     smallest and largest known doc_id of the block
    most_id
    doc_ids      the block's documents in order
    lengths      ids of each, end id included
    width        bits of an id
    payload      all ids of the block, each ``width`` bits, lowest bit first, no gaps

Id number i of a block lies at bit ``i * width``, so a document, or any slice of one,
is read without touching what is before it. Blocks are stored as rows of Parquet files:
Spark's committer keeps half-written files of lost tasks out, and any store it reads works.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm.common import grouped, let_go, texts
from corpusloom.llm.word_cache import word_encoder

BLOCK_IDS = 65_536
# Widths whose runs of bits are plain little-endian integers.
WHOLE_BYTES = (8, 16, 32)
GROUP = 1_000_000

BLOCKS = (
    "shard int, block int, first long, least_id long, most_id long, "
    "doc_ids array<long>, lengths array<long>, width int, payload binary"
)


def bits_for(vocabulary: int) -> int:
    """The fewest bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, width: int) -> bytes:
    """Ids as a gapless run of ``width``-bit numbers, lowest bit first."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"id {int(ids.max())} does not fit in {width} bits")
    if width in WHOLE_BYTES:
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack_ids(payload: bytes, width: int, start: int = 0, count: int | None = None) -> np.ndarray:
    """``count`` ids from number ``start`` on; only their own bytes are looked at."""
    if count is None:
        count = len(payload) * 8 // width - start
    if count <= 0:
        return np.empty(0, "<u4")
    if width in WHOLE_BYTES:
        return np.frombuffer(payload, f"<u{width // 8}", count, start * width // 8).astype("<u4")
    first, last = start * width // 8, -(-(start + count) * width // 8)
    raw = np.frombuffer(payload, np.uint8, last - first, first)
    bits = np.unpackbits(raw, bitorder="little")[start * width - first * 8 :][: count * width].reshape(count, width)
    whole = np.zeros((count, 32), np.uint8)
    whole[:, :width] = bits
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()


def _starts(rows: DataFrame, shards: int) -> list[tuple[bool, int, int]]:
    """The first (doc_id is known, doc_id, tie) of each shard, from a range partition of these keys alone."""
    at = rows.select(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"), "_tie")
    at = at.repartitionByRange(shards, "known", "id", "_tie")
    first = at.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("known", "id", "_tie")).alias("first"))
    return sorted((r.first.known, r.first.id, r.first._tie) for r in first.collect())  # a row per shard


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, shards: int | None = None) -> None:
    """Encodes ``docs`` (doc_id, text), adds ``end_id`` to each, and writes token files in doc_id order.

    The order is that of (doc_id, hash of the text), so that neither one id nor one
    source gathers in a shard. Where shards begin is found from these keys alone; texts are
    encoded where they are read, and only ids, two bytes each, are shuffled and sorted.
    Null ids come first; rows with equal ids are ordered by their text's hash; a null
    text is empty and has the end id alone; a very long text is a block of its own. Other
    columns are left aside. An empty table writes a table of no blocks. ``shards`` is by
    default the number of input splits, at least that of shuffle partitions.
    """
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = _starts(rows, shards or max(least, docs.rdd.getNumPartitions()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        if end_id >> 8 * encoder.width:
            raise ValueError(f"end id {end_id} is outside the vocabulary's width")
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            keys = zip(batch.column("doc_id").to_pylist(), batch.column("_tie").to_pylist())
            shard = [bisect_right(starts, (i is not None, i or 0, tie)) - 1 for i, tie in keys]
            ids = [x + end for group in grouped(texts(batch), GROUP) for x in encoder.encode_all(group)]
            columns = [pa.array(shard, pa.int32()), batch.column("doc_id"), batch.column("_tie"), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "doc_id", "_tie", "ids"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        vocabulary = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)
        width, dtype = bits_for(max(vocabulary, end_id + 1)), np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")
        shard, block, first = None, 0, 0
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, first, held, size
            known = [i for i, _ in held if i is not None]
            row = pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "block": pa.array([block], pa.int32()),
                    "first": pa.array([first], pa.int64()),
                    "least_id": pa.array([known[0] if known else None], pa.int64()),
                    "most_id": pa.array([known[-1] if known else None], pa.int64()),
                    "doc_ids": pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
                    "lengths": pa.array([[len(x) // dtype.itemsize for _, x in held]], pa.list_(pa.int64())),
                    "width": pa.array([width], pa.int32()),
                    "payload": pa.array([pack_ids(np.frombuffer(b"".join([x for _, x in held]), dtype), width)], pa.binary()),
                }
            )
            block, first, held, size = block + 1, first + size, [], 0
            return row

        for batch in batches:
            for number, doc_id, ids in zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids")):
                if number != shard:
                    if held:
                        yield flush()
                    shard, block, first = number, 0, 0
                held.append((doc_id, ids.as_py()))
                size += len(held[-1][1]) // dtype.itemsize
                if size >= BLOCK_IDS:
                    yield flush()
        if held:
            yield flush()

    encoded = rows.mapInArrow(encode, "shard int, doc_id long, _tie long, ids binary")
    ordered = encoded.repartition(max(1, len(starts)), "shard").sortWithinPartitions("shard", "doc_id", "_tie")
    ordered.mapInArrow(pack, BLOCKS).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """Documents of token files: doc_id, start (ids of all before), n_tokens, ids_crc32 and, if asked for, ids.

    ids_crc32 is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit
    integers. Each block is unpacked by itself; starts of shards are sums over one count per shard.
    """
    schema = "doc_id long, shard int, at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                starts = np.cumsum(lengths) - lengths
                found = unpack_ids(row["payload"], row["width"], 0, int(lengths.sum()))
                parts = [found[a : a + n] for a, n in zip(starts.tolist(), lengths.tolist())]
                columns = {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "shard": pa.array([row["shard"]] * len(parts), pa.int32()),
                    "at": pa.array(starts + row["first"], pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                }
                if ids:
                    columns["ids"] = pa.array([p.tolist() for p in parts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    blocks = spark.read.schema(BLOCKS).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    sizes = blocks.select("shard", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n).alias("_n"))
    shards = sizes.groupBy("shard").agg(F.sum("_n").alias("_n"))
    shards = shards.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = blocks.mapInArrow(run, schema).join(shards, "shard")
    return rows.select(
        "doc_id", (F.col("_before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else [])
    )


def read_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """(doc_id, n_tokens, ids) of the given documents; of a block, only their slices are unpacked.

    Blocks whose range holds none of ``doc_ids`` are passed over: by Parquet's own statistics if they lie
    outside the range of all of them, else by their first and last id. Repeated
    doc_ids come as often as they stand in the files, unknown ones not at all. The list is
    part of the plan, so it should be short.
    """
    wanted = sorted({int(i) for i in doc_ids})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                here = set(wanted[bisect_left(wanted, row["least_id"]) : bisect_right(wanted, row["most_id"])])
                at, found = 0, []
                for doc_id, length in zip(row["doc_ids"], row["lengths"]):
                    if doc_id in here:
                        found.append((doc_id, length, unpack_ids(row["payload"], row["width"], at, length).tolist()))
                    at += length
                columns = list(zip(*found)) or [(), (), ()]
                types = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "n_tokens", "ids"])

    blocks = spark.read.schema(BLOCKS).parquet(path)
    if not wanted:
        return blocks.where(F.lit(False)).mapInArrow(run, "doc_id long, n_tokens long, ids array<long>")
    inside = (F.col("most_id") >= wanted[0]) & (F.col("least_id") <= wanted[-1])
    some = F.exists(F.lit(wanted), lambda i: (i >= F.col("least_id")) & (i <= F.col("most_id")))
    return blocks.where(inside & some).mapInArrow(run, "doc_id long, n_tokens long, ids array<long>")
