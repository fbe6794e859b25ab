"""Phrase collocations: n-gram counts from FM-indexes over word ids, one index per shard, summed across shards.

Each task cuts the texts it reads into shards of about ``SHARD_WORDS`` words, numbers the
words of a shard, and indexes the shard's text in both directions. Phrases are intervals of
both indexes; a phrase grows to the right through the one and to the left through the other,
for all phrases of a length at once. A shard therefore knows each n-gram with its count and
its extensions, and the counts of all shards are summed by phrase.

Lengths are mined one after the other. A phrase can only be frequent if its parts are, so a
shard extends only what is frequent over the whole corpus. It asks a Bloom filter of at most
32 MB, whatever the corpus: what passes it by mistake is counted and dropped afterwards, so
results are exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import staged

SHARD_WORDS = 1_000_000
# Longer texts are taken in slices of about so many bytes, cut after white space or the end of a piece.
SLICE = 4 << 20
OUT_ROWS = 100_000
UNKNOWN = "und"

# Bytes that end a piece; bytes between words. 0xFF occurs in no UTF-8 text.
ENDS, BLANKS, END = b".,;:!?\n\x0b\x0c\r", b" \t", b"\xff"
TABLE = bytes.maketrans(ENDS + b"\t", END * len(ENDS) + b" ")
BREAK = re.compile(b"[" + re.escape(ENDS + BLANKS) + b"]")

FILTER_BITS = (15, 28)  # 4 KB to 32 MB, as powers of two
PER_PHRASE = 16
# Odd multipliers of the filter's hashes.
SPREAD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
STEP = np.uint64(0xD6E8FEB86659FD93)


class WordIndex:
    """A bidirectional FM-index of a circular text of word ids.

    Id 0 ends a piece. Forward, positions are sorted by the words from there on and hold the
    word ``before``; backward, by the words up to there and hold the word ``after``. Either order
    looks at as many words as the longest phrase that is grown through it; 0 leaves it out.
    A phrase is (start forward, start backward, size): the interval of its occurrences in each.
    """

    def __init__(self, text: np.ndarray, forward: int, backward: int) -> None:
        self.n = len(text)
        self.words = int(text.max(initial=0)) + 1
        self.before = np.roll(text, 1)[self._sorted(text, forward, 1)] if forward else None
        self.after = np.roll(text, -1)[self._sorted(text, backward, -1)] if backward else None
        self.sizes = np.bincount(text, minlength=self.words)
        self._places: dict[str, np.ndarray] = {}

    def _sorted(self, text: np.ndarray, depth: int, step: int) -> np.ndarray:
        """Positions by their ``depth`` words in the direction ``step``."""
        rank, most = text.astype(np.int64), self.words
        for reach in range(1, depth):
            if most * self.words >= 1 << 63:
                kept, rank = np.unique(rank, return_inverse=True)
                most = len(kept)
            rank, most = rank * self.words + np.roll(text, -step * reach), most * self.words
        return np.argsort(rank)  # the order of equals does not matter

    def single(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All words but 0 as phrases of one: words, starts forward, starts backward, sizes."""
        words = np.flatnonzero(self.sizes[1:]) + 1
        starts = (np.cumsum(self.sizes) - self.sizes)[words]
        return words, starts, starts, self.sizes[words]

    def _start(self, side: str, word: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Where the word's phrases start in the index ``side``: the word's start plus its places before ``lo``."""
        if side not in self._places:
            column = getattr(self, side).astype(np.int64)
            self._places[side] = np.sort(column * (self.n + 1) + np.arange(self.n))
        return np.searchsorted(self._places[side], word * (self.n + 1) + lo)

    def _step(self, side: str, lo: np.ndarray, other: np.ndarray, size: np.ndarray, again: bool):
        """Every way to grow the phrases by a word of ``side``: phrase, word, both starts, size.

        In the other index, the interval is cut up in the order of the new words. Starts in an
        index that is not used ``again`` are not looked up.
        """
        column = getattr(self, side)
        phrase = np.repeat(np.arange(len(lo)), size)
        at = np.arange(len(phrase)) - np.repeat(np.cumsum(size) - size, size) + lo[phrase]
        found, count = np.unique(phrase * self.words + column[at], return_counts=True)
        phrase, word = found // self.words, found % self.words
        smaller = np.cumsum(count) - count
        smaller -= smaller[np.searchsorted(phrase, np.arange(len(lo)))][phrase]
        start = self._start(side, word, lo[phrase]) if again else count
        kept = word != 0
        return tuple(x[kept] for x in (phrase, word, start, other[phrase] + smaller, count))

    def grow_right(self, forward: np.ndarray, backward: np.ndarray, size: np.ndarray, again: bool = True):
        """Phrase, the word put behind it, start forward, start backward, size."""
        phrase, word, back, ahead, count = self._step("after", backward, forward, size, again)
        return phrase, word, ahead, back, count

    def grow_left(self, forward: np.ndarray, backward: np.ndarray, size: np.ndarray, again: bool = True):
        """Phrase, the word put before it, start forward, start backward, size."""
        return self._step("before", forward, backward, size, again)


class Filter:
    """A Bloom filter of phrases: a bit string of a power of two, three bits a phrase."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits
        self.power = (len(bits) * 8).bit_length() - 1

    @staticmethod
    def places(hashes: np.ndarray, power: int) -> np.ndarray:
        return np.concatenate([(hashes * s) >> np.uint64(64 - power) for s in SPREAD]).astype(np.int64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = self.places(hashes, self.power)
        return ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool).reshape(len(SPREAD), -1).all(axis=0)


def word_hashes(lang: str, words: Iterable[bytes]) -> list[int]:
    seed, digest = xxhash.xxh64_intdigest(lang), xxhash.xxh64_intdigest
    return [digest(w, seed) for w in words]


def phrase_hash(columns: list[np.ndarray]) -> np.ndarray:
    """From the hashes of the words, a column per place in the phrase."""
    return reduce(lambda h, w: (h ^ (h >> np.uint64(31))) * STEP + w, columns)


class Vocabulary(dict):
    """Ids of one language's words in a shard; a new word takes the shard's next id."""

    def __init__(self, lang: str, words: list[bytes], langs: list[str]) -> None:
        super().__init__({END: 0})
        self.lang, self.words, self.langs = lang, words, langs

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return number


class Shard:
    """The text of one shard as it is read: ids of the words, a vocabulary for each language."""

    def __init__(self) -> None:
        self.words: list[bytes] = [b""]
        self.langs: list[str] = [""]
        self.ids: dict[str, Vocabulary] = {}
        self.text: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.size = 0

    def add(self, lang: str, tokens: list[bytes]) -> None:
        if lang not in self.ids:
            self.ids[lang] = Vocabulary(lang, self.words, self.langs)
        self.text.append(np.fromiter(map(self.ids[lang].__getitem__, tokens), np.int64, len(tokens)))
        self.size += len(tokens)

    def hashes(self) -> np.ndarray:
        found = np.zeros(len(self.words), np.uint64)
        for lang, ids in self.ids.items():
            found[np.fromiter(ids.values(), np.int64, len(ids))] = word_hashes(lang, ids)
        return found

    def end(self) -> None:
        self.text.append(np.zeros(1, np.int64))

    def tail(self, words: int) -> list[bytes]:
        """The last words of the open piece, ``words`` at most."""
        last: list[bytes] = []
        for part in reversed(self.text):
            for i in reversed(part[-words:].tolist() if words else []):
                if i == 0 or len(last) == words:
                    return last[::-1]
                last.append(self.words[i])
        return last[::-1]

    def count(self, length: int, filters: dict[int, Filter]) -> tuple[list[np.ndarray], np.ndarray]:
        """Word ids of each phrase of ``length``, a column per place, and its count in this shard."""
        text = np.concatenate(self.text)
        if length == 1:
            sizes = np.bincount(text, minlength=1)
            words = np.flatnonzero(sizes[1:]) + 1
            return [words], sizes[words]
        hashes = self.hashes()
        # Words that are in no frequent phrase end a piece; the others are numbered anew without gaps.
        common = filters[1].holds(hashes)
        common[0] = False
        kept, text = np.unique(np.where(common[text], text, 0), return_inverse=True)
        if kept[0] != 0:
            kept, text = np.concatenate([[0], kept]), text + 1
        # Phrases grow by turns, to even lengths to the right and to odd lengths to the left.
        index = WordIndex(text, forward=(length - 1) // 2 * 2, backward=length // 2 * 2 - 1)
        word, forward, backward, size = index.single()
        columns = [word]
        for grown in range(2, length + 1):
            grow = index.grow_left if grown % 2 else index.grow_right
            phrase, word, forward, backward, size = grow(forward, backward, size, again=grown + 2 <= length)
            columns = [c[phrase] for c in columns]
            columns = [word, *columns] if grown % 2 else [*columns, word]
            if grown < length:
                good = filters[grown].holds(phrase_hash([hashes[kept[c]] for c in columns]))
                columns, forward, backward, size = [c[good] for c in columns], forward[good], backward[good], size[good]
            elif grown > 2:
                # The part that the last step added must be frequent as well.
                part = columns[:-1] if grown % 2 else columns[1:]
                good = filters[grown - 1].holds(phrase_hash([hashes[kept[c]] for c in part]))
                columns, size = [c[good] for c in columns], size[good]
        return [kept[c] for c in columns], size

    def rows(self, length: int, filters: dict[int, Filter]) -> Iterator[pa.RecordBatch]:
        columns, counts = self.count(length, filters)
        words, langs = pa.array(self.words, pa.binary()), pa.array(self.langs, pa.string())
        if length == 1:
            # How many words each language has: rows without a phrase.
            first = np.array([[*self.ids].index(x) for x in self.langs[1:]], np.int64)
            totals = np.bincount(first[columns[0] - 1], counts, len(self.ids)).astype(np.int64) if self.ids else []
            yield _batch(pa.array([*self.ids], pa.string()), pa.nulls(len(self.ids), pa.string()), totals)
        for at in range(0, len(counts), OUT_ROWS):
            ids = [c[at : at + OUT_ROWS] for c in columns]
            phrase = pc.binary_join_element_wise(*[words.take(pa.array(i)) for i in ids], b" ") if length > 1 else words.take(pa.array(ids[0]))
            yield _batch(langs.take(pa.array(ids[0])), phrase.cast(pa.string()), counts[at : at + OUT_ROWS])


def _batch(lang: pa.Array, phrase: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, phrase, pa.array(counts, pa.int64())], ["lang", "phrase", "n"])


def slices(text: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text, with 0xFF where a piece ends, a slice of the text at a time."""
    text, at = text.lower(), 0  # bytes: A-Z only
    while at < len(text):
        end = len(text) if len(text) - at <= size else None
        if end is None:
            stop = BREAK.search(text, at + size)
            end = stop.end() if stop else len(text)
        yield text[at:end].translate(TABLE).replace(END, b" \xff ").split()
        at = end


def _count_shards(docs: DataFrame, length: int, filters: dict[int, Broadcast], shard_words: int) -> DataFrame:
    """(lang, phrase, n): the phrases of ``length`` of every shard with their counts there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: Filter(np.frombuffer(b.value, np.uint8)) for k, b in filters.items()}
        shard = Shard()
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, value in zip(langs, batch.column(1)):
                for tokens in slices(value.as_buffer().to_pybytes() if value.is_valid else b""):
                    if shard.size >= shard_words:
                        # A piece may go on: its last words are context, too few to be counted again.
                        tail = shard.tail(length - 1)
                        yield from shard.rows(length, known)
                        shard = Shard()
                        shard.add(lang, tail)
                    shard.add(lang, tokens)
                shard.end()
                if shard.size >= shard_words:
                    yield from shard.rows(length, known)
                    shard = Shard()
        if shard.size:
            yield from shard.rows(length, known)

    return docs.mapInArrow(run, "lang string, phrase string, n long")


def _filter(phrases: DataFrame) -> Broadcast:
    """The Bloom filter of ``phrases`` (lang, phrase); tasks set bits, the parts of the bit string are united."""
    low, high = FILTER_BITS
    power = min(high, max(low, (PER_PHRASE * phrases.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = [word_hashes(l, p.encode().split(b" ")) for l, p in zip(*(c.to_pylist() for c in batch.columns))]
            if not rows:
                continue
            at = Filter.places(phrase_hash([np.array(c, np.uint64) for c in zip(*rows)]), power)
            for part in np.unique(at >> low).tolist():
                bits = parts.setdefault(part, np.zeros(1 << low, np.uint8))
                bits[at[at >> low == part] & ((1 << low) - 1)] = 1
        packed = [np.packbits(b, bitorder="little").tobytes() for b in parts.values()]
        yield pa.RecordBatch.from_arrays([pa.array([*parts], pa.int64()), pa.array(packed, pa.binary())], ["part", "bits"])

    spark = phrases.sparkSession
    united = phrases.select("lang", "phrase").mapInArrow(run, "part long, bits binary").groupBy("part").agg(F.bitmap_or_agg("bits").alias("bits"))
    whole = bytearray(1 << power - 3)
    size = 1 << low - 3
    for row in united.toLocalIterator():  # at most 8,192 parts of 4 KB
        whole[row.part * size : (row.part + 1) * size] = row.bits
    return spark.sparkContext.broadcast(bytes(whole))


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words that occur ``least`` times in their language, and the languages' word counts.

    The phrases are (lang, phrase, f, words), the counts (lang, n). See ``mine`` for the rules.
    """
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"))
    filters: dict[int, Broadcast] = {}
    found: list[DataFrame] = []
    for length in range(1, longest + 1):
        counts = _count_shards(texts, length, filters, shard_words)
        summed = counts.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("phrase").isNull() | (F.col("f") >= least))
        found.append(staged(summed.withColumn("words", F.lit(length)), f"phrases-{length}"))
        if length < longest:
            filters[length] = _filter(found[-1].where("phrase is not null"))
    totals = found[0].where("phrase is null").select("lang", F.col("f").alias("n"))
    return reduce(DataFrame.union, [found[0].where("phrase is not null"), *found[1:]]), totals


def mine(
    docs: DataFrame, longest: int = 3, least: int = 10, covered: int = 50, top: int = 2_000, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """The best phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score, cut.

    Texts are lower-cased (A-Z only), cut into pieces at ``.,;:!?`` and line ends, and these into
    words at spaces and tabs. a is the phrase's count (``least`` or more), n the language's words.
    Cut after its first ``cut`` words, l and r are the counts of both parts and the score is
    floor(1,000,000 a a / (l r)); the lowest-scoring cut counts, of equal ones the first. A phrase
    goes if a longer one that contains it has at least ``covered`` percent of its count. ``top``
    is the length of the report, by score, then a, then phrase.

    A null language is ``und``; null and empty texts have no words; texts of any length are read
    whole; repeated rows count as often as they come; an empty table gives no rows. Columns other
    than lang and text are left aside.
    """
    phrases, totals = frequent_phrases(docs, longest, least, shard_words)
    words = F.split("phrase", " ")
    many = phrases.where("words > 1").withColumnRenamed("f", "a").withColumn("_w", words)

    def part(start: str, length: str) -> F.Column:
        return F.expr(f"array_join(slice(_w, {start}, {length}), ' ')")

    cuts = many.withColumn("cut", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.select("lang", "phrase", "a", "cut", part("1", "cut").alias("_l"), part("cut + 1", "words - cut").alias("_r"))
    for side in ("l", "r"):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(f"_{side}"), F.col("f").alias(side)), ["lang", f"_{side}"])
    # Products of 10^6 and two counts below 10^15 fit 38 digits.
    score = F.expr("(cast(1000000 as decimal(7, 0)) * cast(a as decimal(15, 0)) * cast(a as decimal(15, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b")).select("lang", "phrase", "a", "b.*")

    inner = many.where("words > 2").withColumn("_n", F.explode(F.expr("sequence(2, words - 1)")))
    inner = inner.withColumn("_at", F.explode(F.expr("sequence(1, words - _n + 1)")))
    longer = inner.groupBy("lang", part("_at", "_n").alias("phrase")).agg(F.max("a").alias("_longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (F.col("_longer") * 100 < F.col("a") * covered))

    # A language's best are chosen in two steps, so that one task never ranks what all others sent.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    lane = Window.partitionBy("lang", "_lane").orderBy(*order)
    kept = kept.withColumn("_lane", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(lane)).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return kept.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", F.col("cut").cast("long").alias("cut")
    )
