"""SimHash near-duplicates by deletion-variant signatures.

Two fingerprints that differ in at most k bits, cut into k // 2 + 1 segments, differ in
at most one bit in some segment. So each distinct fingerprint is indexed under every
one of its segments with a few neighbouring bits left open: two that agree but for one bit meet
under the variant with that bit open. An equality join finds them, the whole distance verifies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import discard, free_name, let_go, numbered, recorded, staged, texts
from corpusloom.llm.components import connected

BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 2
# Hashes are counted bit by bit so many at a time.
CHUNK = 65_536
# A variant leaves so many bits open, fewer if less than CLOSED bits of its segment would be left.
OPEN, CLOSED = 4, 28
# So many kept rows are broadcast as words of 64 bits; more are joined.
MARKED_ROWS = 64_000_000


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles, unsigned; 0 for a text without words.

    ASCII letters count in lower case; words are cut at ASCII white space. A text of
    fewer words than a shingle is one shingle. A bit is set if over half of all
    shingles, repeats included, have it in their XXH64.
    """
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, row: str | None = None) -> DataFrame:
    """doc_id, its fingerprint as a signed long of the same bits, and the long column ``row``, if named, as row_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.int64()), batch.column("row_id")], ["doc_id", "bits", "row_id"]
            )

    rows = docs.selectExpr("cast(doc_id as long) doc_id", f"cast(`{row or 'doc_id'}` as long) row_id", "cast(text as string) text")
    return rows.mapInArrow(run, "doc_id long, bits long, row_id long").select("doc_id", "bits", *(["row_id"] if row else []))


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    count = distance // 2 + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _open(first: int, width: int) -> list[int]:
    """The bits that each variant of a segment leaves open, the segment's lowest bits first."""
    step, end = max(1, min(OPEN, width - CLOSED)), first + width
    return [(1 << min(at + step, end)) - (1 << at) for at in range(first, end, step)]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _segment(bits: Column, first: int, width: int) -> Column:
    """The bits of a segment, in place, as a long."""
    return bits.bitwiseAND(F.lit(_signed(((1 << width) - 1) << first)))


def near_pairs(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """All pairs (a, b), a < b, of the distinct longs ``bits`` that differ in at most ``distance`` bits, each once."""
    cut = _segments(distance)
    opened = [_open(first, width) for first, width in cut]
    variants = F.array(
        *(
            F.struct(
                F.lit(_signed(open_)).alias("open"),
                _segment(F.col("bits"), first, width).bitwiseAND(F.lit(_signed(~open_ & (1 << BITS) - 1))).alias("rest"),
            )
            for (first, width), masks in zip(cut, opened)
            for open_ in masks
        )
    )
    index = distinct.select("bits", F.explode(variants).alias("v")).select("bits", "v.*")
    left, right = index.alias("l"), index.alias("r")
    apart = F.col("l.bits").bitwiseXOR(F.col("r.bits"))
    # A pair meets under every variant if a segment is equal; it counts under the first variant
    # of its first segment with at most one bit apart, or under the one that opens the bit that differs.
    counts = F.lit(False)
    for number, (first, width) in enumerate(cut):
        here = _segment(apart, first, width)
        inside = (F.bit_count(here) == 1) & (here.bitwiseAND(F.col("l.open")) == here)
        at = F.when(here == 0, F.col("l.open") == F.lit(_signed(opened[number][0]))).otherwise(inside)
        earlier = F.lit(True)
        for f, w in cut[:number]:
            earlier = earlier & (F.bit_count(_segment(apart, f, w)) > 1)
        counts = counts | (at & earlier)
    same = (F.col("l.open") == F.col("r.open")) & (F.col("l.rest") == F.col("r.rest"))
    near = (F.col("l.bits") < F.col("r.bits")) & (F.bit_count(apart) <= distance)
    return left.join(right, same & near & counts).select(F.col("l.bits").alias("a"), F.col("r.bits").alias("b"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, row: str | None = None
) -> DataFrame:
    """One row per document: doc_id, bits, component_id (the smallest doc_id it is linked with, itself included), links, root.

    ``docs`` needs doc_id and text; other columns are left aside, but the long column
    ``row``, if named, comes back as row_id. Equal fingerprints are one class from the
    start, so copies are never paired; ``links`` counts other classes within ``distance``
    bits, ``root`` is the component's smallest fingerprint. A null or empty text has
    fingerprint zero and is linked like any other. Rows with a null doc_id keep it and get
    the smallest known id of their component, null if there is none; repeated rows give
    repeated results; an empty table gives none.
    """
    if not 0 <= distance < BITS:
        raise ValueError(f"distance must be between 0 and {BITS - 1}")
    rows = staged(fingerprints(docs, shingle, row), "simhash")
    classes = staged(rows.groupBy("bits").agg(F.min("doc_id").alias("least")), "simhash-classes")
    pairs = staged(near_pairs(classes.select("bits"), distance), "simhash-pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("bits")).groupBy("bits").agg(F.count(F.lit(1)).alias("links"))
    roots = connected(pairs, "simhash-links").withColumnRenamed("node", "bits")
    classes = classes.join(roots.join(ends, "bits"), "bits", "left")
    classes = classes.select("bits", "least", F.coalesce("root", "bits").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rows.join(classes.drop("least").join(smallest, "root"), "bits")
    return found.select("doc_id", "bits", "component_id", "links", "root", *(["row_id"] if row else []))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that with the smallest doc_id, else the first read.

    All columns stay as they are. Rows without a doc_id come last in a group; repeated
    rows are a group like any other.
    """
    row = free_name(docs, "_row")
    whole = numbered(docs, row, "simhash-docs")
    with recorded() as made:
        found = near_duplicates(whole, shingle, distance, row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row_id"))
    kept = found.groupBy("root").agg(first.alias("first")).select(F.col("first.row_id").alias(row))
    kept = staged(kept, "simhash-kept")
    discard(docs.sparkSession, made)
    if kept.count() > MARKED_ROWS:
        return whole.join(kept, row, "left_semi").drop(row)
    # Texts stay where they are read: every 64 neighbours share a word with a bit for each.
    word, marks = free_name(whole, "_word"), free_name(whole, "_marks")
    place = F.shiftright(row, 6).alias(word)
    one = F.expr(f"shiftleft(1L, cast(`{row}` & 63 as int))")
    words = kept.select(place, one.alias(marks)).groupBy(word).agg(F.bit_or(marks).alias(marks))
    found = whole.withColumn(word, F.shiftright(row, 6)).join(F.broadcast(words), word)
    return found.where(F.expr(f"getbit(`{marks}`, cast(`{row}` & 63 as int)) = 1")).select(*docs.columns)


def hex_digits(bits: Column) -> Column:
    """16 lower-case hex digits of a long."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
