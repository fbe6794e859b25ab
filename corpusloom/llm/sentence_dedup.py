"""Substring dedup by sliding sentence spans.

A text is cut into sentences. From every sentence on, the shortest run of several
consecutive sentences with enough words is hashed. Runs are compared over all documents;
every sentence that lies in a repeated run which is not the run's first is removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import discard, free_name, let_go, numbered, recorded, staged, texts

# A run has at least so many sentences and so many words.
SENTENCES = 2
WORDS = 25
# A longer sentence is cut every so many words, so that a long one can be part of a run.
LONGEST = 16

# A sentence ends behind . ! ? and white space, at a line's end, or before a word with a
# capital: a passage put into the middle of a sentence starts a new one.
CAPITALS = "A-ZÀ-ÖØ-ÞΑ-ΩА-Я"
BORDER = re.compile(
    rf"""[.!?\s](?:(?<=[.!?])['")\]]*\s+|(?<=\n)\s*|(?<=\s)\s*(?=[{CAPITALS}]))"""
)
TOKEN = re.compile(r"\S+\s*")

RUNS = "h1 long, h2 long, doc_id long, row_id long, at int, n int"


def sentences(text: str) -> list[str]:
    """The sentences of a text; joined they give the text again. White space stays behind its sentence."""
    found: list[str] = []
    at = 0
    for border in [*[m.end() for m in BORDER.finditer(text)], len(text)]:
        part, at = text[at:border], border
        if part.count(" ") < LONGEST:
            if part:
                found.append(part)
            continue
        lead = len(part) - len(part.lstrip())
        tokens = TOKEN.findall(part, lead)
        pieces = ["".join(tokens[i : i + LONGEST]) for i in range(0, len(tokens), LONGEST)] or [""]
        found.extend([part[:lead] + pieces[0], *pieces[1:]])
    return found


def runs(parts: list[str], least: int = SENTENCES, words: int = WORDS) -> list[tuple[int, int, bytes]]:
    """(first sentence, number of sentences, normal form) of each run; white space counts as one space."""
    cut = [p.split() for p in parts]
    flat = [w for c in cut for w in c]
    ends = [0, *accumulate(map(len, cut))]
    found, stop, count = [], 0, len(cut)
    for at in range(count):
        stop = max(stop, at + least)
        while stop <= count and ends[stop] - ends[at] < words:
            stop += 1
        if stop > count:
            break
        found.append((at, stop - at, " ".join(flat[ends[at] : ends[stop]]).encode("utf-8", "replace")))
    return found


def _run_table(docs: DataFrame, row: str, least: int, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            keys = zip(batch.column("doc_id").to_pylist(), batch.column("row_id").to_pylist())
            columns: list[list] = [[], [], [], [], []]
            for (doc_id, row_id), text in zip(keys, texts(batch)):
                found = runs(sentences(text), least, words)
                columns[0].extend([digest(r[2]) for r in found])
                columns[1].extend([doc_id] * len(found))
                columns[2].extend([row_id] * len(found))
                columns[3].extend([r[0] for r in found])
                columns[4].extend([r[1] for r in found])
                if len(columns[0]) >= 100_000:
                    yield _rows(columns)
                    columns = [[], [], [], [], []]
            yield _rows(columns)

    rows = docs.selectExpr("cast(doc_id as long) doc_id", f"`{row}` row_id", "cast(text as string) text")
    return rows.mapInArrow(run, RUNS)


def _rows(columns: list[list]) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(columns[0]), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.ascontiguousarray(halves[:, 0])),
            pa.array(np.ascontiguousarray(halves[:, 1])),
            pa.array(columns[1], pa.int64()),
            pa.array(columns[2], pa.int64()),
            pa.array(columns[3], pa.int32()),
            pa.array(columns[4], pa.int32()),
        ],
        ["h1", "h2", "doc_id", "row_id", "at", "n"],
    )


def remove_repeats(docs: DataFrame, least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``docs`` with repeated spans removed from ``text``, and the count of removed sentences.

    The first place of a run is that with the smallest doc_id, then the first row read,
    then the first position; it stays whole. All other columns are kept as they are; the
    count comes last, as _removed (with more underscores if that name is taken). Rows without a doc_id come after all others. A null
    text stays null; a text that is removed whole becomes empty.
    Copies under one doc_id, or rows that repeat, lose their text but for the first.
    A document's sentences are held one document at a time.
    """
    row = free_name(docs, "_row")
    whole = numbered(docs, row, "spans-docs")
    with recorded() as made:
        spans = staged(_run_table(whole, row, least, words), "spans")
    repeated = spans.groupBy("h1").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("h1")
    # Only runs whose first half of the hash repeats go further.
    near = staged(spans.join(repeated, "h1"), "spans-repeated")
    discard(docs.sparkSession, made)
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row_id", "at")
    first = near.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    first = first.select("h1", "h2", F.col("first.row_id").alias("_row_id"), F.col("first.at").alias("_at"))
    later = near.join(first, ["h1", "h2"]).where("row_id != _row_id or at != _at")
    hits = later.groupBy(F.col("row_id").alias(row)).agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("_hits"))

    names, count = docs.columns, free_name(docs, "_removed")
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            kept, removed = batch.column(text_at).to_pylist(), []
            for at, found in enumerate(batch.column(len(names)).to_pylist()):
                gone = {i for hit in found or () for i in range(hit["at"], hit["at"] + hit["n"])}
                if gone:
                    kept[at] = "".join([p for i, p in enumerate(sentences(kept[at])) if i not in gone])
                removed.append(len(gone))
            columns = [batch.column(i) for i in range(len(names))]
            columns[text_at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int32())], [*names, count])

    joined = whole.join(hits, row, "left").select(*(whole[n] for n in names), "_hits")
    schema = T.StructType([*docs.schema, T.StructField(count, T.IntegerType())])
    return joined.mapInArrow(run, schema)
