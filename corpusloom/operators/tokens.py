"""Tokenizers as column expressions, and the tokenize step.

A tokenizer turns a text column into an array of ids, truncated on the right. The
byte and vocabulary tokenizers run inside the JVM; any other tokenizer is plugged
in as a Python callable that gets Arrow batches of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.cutoff import DIRECT_ROWS, nth_key
from corpusloom.session import new_folder
from corpusloom.sources.sinks import stage
from corpusloom.spec import MAX_SEQ_LENGTH, MIN_TOKENS_BATCH

# Default special ids and vocabulary size.
BOS_ID, EOS_ID, PAD_ID = 1, 2, 0
UNKNOWN_ID = 0
FIRST_PIECE_ID = 3
VOCAB_SIZE = 32_000
# A vocabulary is one row of the lookup and is ranked in one task.
MAX_VOCAB_SIZE = 1 << 18

# A piece is a run of anything but these; Java and SQL engines differ on \s.
PIECE_PATTERN = "[^ \\n\\t\\r]+"
# Slots of the id table: about two per piece.
SLOTS = 1 << 16
# Longer pieces are looked up by digest, which bounds the size of the id table.
LONG_PIECE_BYTES = 64
ID_TABLE = "_id_table"
# A plugged tokenizer gets texts of about so many characters at once: the ids of a text take many times its room.
ENCODED_CHARS = 1 << 18


@dataclass(frozen=True)
class SpecialIds:
    """Beginning, end and padding ids."""

    bos: int = BOS_ID
    eos: int = EOS_ID
    pad: int = PAD_ID

    @classmethod
    def of_tokenizer(cls, bos: int | None = None, eos: int | None = None, pad: int | None = None) -> "SpecialIds":
        """Ids of a tokenizer; padding falls back to the end id, and unset ids to the defaults."""
        pad = eos if pad is None else pad
        return cls(bos or BOS_ID, eos or EOS_ID, pad or PAD_ID)


class Tokenizer:
    """Base: ``ids(text, max_length)`` gives the ids, ``count(text, max_length)`` how many.

    ``attach(rows)`` adds the columns in ``helpers`` that ``ids`` needs, if any.
    """

    special = SpecialIds()
    helpers: tuple[str, ...] = ()

    @property
    def counts_cheaply(self) -> bool:
        return type(self).count is not Tokenizer.count

    def attach(self, rows: DataFrame) -> DataFrame:
        return rows

    def ids(self, text: Column, max_length: int = MAX_SEQ_LENGTH) -> Column:
        raise NotImplementedError

    def count(self, text: Column, max_length: int = MAX_SEQ_LENGTH) -> Column:
        return F.size(self.ids(text, max_length))


@dataclass(frozen=True)
class ByteTokenizer(Tokenizer):
    """The begin id, then each UTF-8 byte plus 3."""

    special: SpecialIds = field(default_factory=SpecialIds)

    def ids(self, text: Column, max_length: int = MAX_SEQ_LENGTH) -> Column:
        first = F.array(F.lit(self.special.bos))
        if max_length <= 1:
            return first
        head = F.substring(F.encode(text, "utf-8"), 1, max_length - 1)
        # One Latin-1 character per byte, so that the split yields the bytes.
        singles = F.split(F.decode(head, "ISO-8859-1"), "")
        body = F.transform(singles, lambda c: F.ascii(c) + F.lit(FIRST_PIECE_ID))
        return F.when(text == "", first).otherwise(F.concat(first, body))

    def count(self, text: Column, max_length: int = MAX_SEQ_LENGTH) -> Column:
        return F.least(F.octet_length(text) + F.lit(1), F.lit(max_length))


def pieces(text: Column) -> Column:
    """The non-space runs of a text, in order."""
    return F.regexp_extract_all(text, F.lit(PIECE_PATTERN), F.lit(0))


def build_vocabulary(rows: DataFrame, text: str = "text", size: int = VOCAB_SIZE, direct: int = DIRECT_ROWS) -> DataFrame:
    """``(piece, id, n)`` of the most frequent pieces, equals by piece; ids below 3 are special.

    A word count: pieces are counted before the exchange, so a very frequent piece is
    one row per task. The counts are written once, and the vocabulary reads from there,
    however often it is used. How many pieces have each count gives the count at the
    cut; of the pieces with just that count, the n-th is found as a cap is. Only the
    chosen pieces, ``size`` at most, are ranked.
    """
    if not FIRST_PIECE_ID < size <= MAX_VOCAB_SIZE:
        raise ValueError(f"a vocabulary has {FIRST_PIECE_ID + 1} to {MAX_VOCAB_SIZE} entries, got {size}")
    counts = rows.select(F.explode(pieces(F.col(text))).alias("piece")).groupBy("piece").agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = stage(counts, new_folder(rows.sparkSession, "pieces"), "rows")
    wanted = size - FIRST_PIECE_ID
    # Few rows: pieces that share a count are one of them.
    above = Window.partitionBy(F.lit(1)).orderBy(F.col("n").desc())
    reach = counts.groupBy("n").agg(F.count(F.lit(1)).alias("pieces"))
    reach = reach.withColumn("upto", F.sum("pieces").over(above)).where(F.col("upto") >= wanted)
    cut = reach.orderBy(F.col("n").desc()).first()
    chosen = counts
    if cut is not None and cut["upto"] > wanted:
        ties = counts.where(F.col("n") == cut["n"])
        last = nth_key(ties, ["piece"], wanted - (cut["upto"] - cut["pieces"]), direct, cut["pieces"])["piece"]
        chosen = counts.where((F.col("n") > cut["n"]) | ((F.col("n") == cut["n"]) & (F.col("piece") <= last)))
    elif cut is not None:
        chosen = counts.where(F.col("n") >= cut["n"])
    order = Window.partitionBy(F.lit(1)).orderBy(F.col("n").desc(), "piece")
    return chosen.select("piece", (F.row_number().over(order) + F.lit(FIRST_PIECE_ID - 1)).alias("id"), "n")


def _lookup_key(piece: Column) -> Column:
    # No piece holds a space, so a digest cannot be taken for a piece.
    return F.when(F.octet_length(piece) <= LONG_PIECE_BYTES, piece).otherwise(F.concat(F.lit(" "), F.md5(piece)))


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def id_table(vocabulary: DataFrame) -> DataFrame:
    """The vocabulary as one row: an array of small maps, indexed by hash slot.

    Used as a scalar subquery it replaces exploding every text and joining the
    pieces. Its size is bounded: ``MAX_VOCAB_SIZE`` entries of at most 64 bytes and an id.
    """
    keyed = vocabulary.select(_lookup_key(F.col("piece")).alias("key"), "id")
    slots = keyed.groupBy(_slot(F.col("key")).alias("slot")).agg(F.collect_list(F.struct("key", "id")).alias("entries"))
    every = vocabulary.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("slot"))
    # At most one row per slot.
    filled = every.join(F.broadcast(slots), "slot", "left")
    in_order = F.array_sort(F.collect_list(F.struct("slot", "entries")))
    return filled.agg(F.transform(in_order, lambda s: F.map_from_entries(s["entries"])).alias("ids"))


@dataclass(frozen=True)
class VocabTokenizer(Tokenizer):
    """The begin id, then the id of each piece (0 outside the vocabulary)."""

    vocabulary: DataFrame
    special: SpecialIds = field(default_factory=SpecialIds)
    helpers = (ID_TABLE,)

    def attach(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(ID_TABLE, id_table(self.vocabulary).scalar())

    def ids(self, text: Column, max_length: int = MAX_SEQ_LENGTH) -> Column:
        def piece_id(piece: Column) -> Column:
            key = _lookup_key(piece)
            return F.coalesce(F.get(F.col(ID_TABLE), _slot(key))[key], F.lit(UNKNOWN_ID))

        body = F.transform(F.slice(pieces(text), 1, max_length - 1), piece_id)
        return F.concat(F.array(F.lit(self.special.bos)), body)

    def count(self, text: Column, max_length: int = MAX_SEQ_LENGTH) -> Column:
        return F.least(F.regexp_count(text, F.lit(PIECE_PATTERN)) + F.lit(1), F.lit(max_length))


def _by_size(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in order, in lists of about ``ENCODED_CHARS`` together; a longer text comes alone."""
    first, held = 0, 0
    for at, text in enumerate(texts):
        if at > first and held + len(text or "") > ENCODED_CHARS:
            yield texts[first:at]
            first, held = at, 0
        held += len(text or "")
    if first < len(texts) or not texts:
        yield texts[first:]


@dataclass(frozen=True)
class PluggedTokenizer(Tokenizer):
    """Any callable ``list[str] -> list[list[int]]``.

    ``load`` runs once per worker process and returns the callable, so a model file
    is opened there and not shipped with every task. It is called with a part of an
    Arrow batch at a time (``ENCODED_CHARS``); the ids of one part are held at once.
    """

    load: Callable[[], Callable[[Sequence[str]], Sequence[Sequence[int]]]]
    special: SpecialIds = field(default_factory=SpecialIds)

    def ids(self, text: Column, max_length: int = MAX_SEQ_LENGTH) -> Column:
        load = self.load

        @F.pandas_udf("array<int>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            call = load()
            for texts in batches:
                for part in _by_size(texts.tolist()):
                    yield pd.Series([list(ids)[:max_length] for ids in call(part)], dtype=object)

        # Not because its result varies: the optimizer must not copy the call into filters on its result.
        return encode.asNondeterministic()(text)


def enough_tokens(
    rows: DataFrame, tokenizer: Tokenizer, text: str = "text", max_length: int = MAX_SEQ_LENGTH,
    min_tokens: int = MIN_TOKENS_BATCH,
) -> DataFrame:
    """Text rows with at least ``min_tokens`` tokens, by the tokenizer's count."""
    return rows.where(tokenizer.count(F.col(text), max_length) >= min_tokens)


def encode(rows: DataFrame, tokenizer: Tokenizer, text: str = "text", max_length: int = MAX_SEQ_LENGTH) -> DataFrame:
    """Replace the text by ``input_ids`` and ``attention_mask``."""
    encoded = tokenizer.attach(rows).withColumn("input_ids", tokenizer.ids(F.col(text), max_length))
    return with_mask(encoded.drop(text, *tokenizer.helpers))


def with_mask(rows: DataFrame) -> DataFrame:
    """Add ``attention_mask``: 1 for each token."""
    return rows.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))


def tokenize(
    rows: DataFrame,
    tokenizer: Tokenizer,
    text: str = "text",
    max_length: int = MAX_SEQ_LENGTH,
    min_tokens: int = MIN_TOKENS_BATCH,
) -> DataFrame:
    """Replace the text by ``input_ids`` and ``attention_mask``; drop short rows.

    Short rows are dropped before they are encoded, if the tokenizer can count
    without encoding.
    """
    if tokenizer.counts_cheaply:
        return encode(enough_tokens(rows, tokenizer, text, max_length, min_tokens), tokenizer, text, max_length)
    return encode(rows, tokenizer, text, max_length).where(F.size("input_ids") >= min_tokens)


def map_batches(rows: DataFrame, function: Callable, schema: str) -> DataFrame:
    """Apply ``function`` (pandas frame in, pandas frame out) to Arrow batches of rows."""

    def run(frames: Iterator) -> Iterator:
        for frame in frames:
            yield function(frame)

    return rows.mapInPandas(run, schema)
