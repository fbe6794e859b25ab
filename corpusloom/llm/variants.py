"""Spelling variants: words one edit apart, found with bidirectional FM-indexes over shards of the vocabulary.

Search scheme for one error: cut a word in two; in any word near it one half is intact, at
its own end of the word. So one search matches the first half exactly behind a word's start and
goes on to the right, another matches the second half before a word's end and goes on to the
left; each crosses the other half with one error. The index answers both directions with
intervals of suffix ranks.

Words that share an end go to the same shard, so the vocabulary is never searched as a whole: a
word of length L is indexed under its first and under its last (L - 1) // 2 letters, and a query of
length m looks where words of length m - 1, m and m + 1 with its own ends are. Shards that
gather too much are cut into a grid of index parts and query parts.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import MAX_BUCKETS, staged

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Code points of the words of a shard, and those beyond which a shard is cut.
SHARD, SHARD_MOST = 200_000, 800_000
# Code points of the queries beyond which those of a shard are cut.
QUERY_MOST = 4_000_000

# Which errors a query allows, by what they do to the word that is found.
SAME, LONGER, SHORTER = 1, 2, 4
RIGHT, LEFT = 0, 1


def _codes(words: Sequence[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4")


class VocabularyIndex:
    """FM-indexes of the circular text ``#word#word...#``, one for each direction. Words are distinct.

    ``column[LEFT]`` holds the letter before each suffix, in the order of the suffixes;
    ``column[RIGHT]`` the letter behind each prefix, in the order of the prefixes read backwards.
    """

    def __init__(self, words: Sequence[str]) -> None:
        lengths = np.array([len(w) for w in words], np.int64)
        self.n = int(lengths.sum()) + len(words)
        text = np.zeros(self.n, np.uint32)
        borders = np.cumsum(lengths + 1) - lengths - 1
        inside = np.ones(self.n, bool)
        inside[borders] = False
        text[inside] = _codes(words)
        self.letters, text = np.unique(text, return_inverse=True)
        text = text.astype(np.uint16)
        self.word_at = np.cumsum(~inside) - 1
        self.words = len(words)
        self.order, self.column, self.places = [], [], []
        for step in (-1, 1):
            order = self._sorted(text, step)
            column = np.roll(text, step)[order]
            by_letter = np.argsort(column, kind="stable")
            self.order.append(order)
            self.column.append(column)
            self.places.append(column[by_letter].astype(np.int64) * (self.n + 1) + by_letter)

    @staticmethod
    def _sorted(text: np.ndarray, step: int) -> np.ndarray:
        """Positions by the circular text from there on in the direction ``step``, by doubling."""
        rank, reach = np.unique(text, return_inverse=True)[1], 1
        while True:
            found, rank = np.unique(rank * np.int64(len(text)) + np.roll(rank, -step * reach), return_inverse=True)
            reach *= 2
            if len(found) == len(text) or reach >= 2 * len(text):
                return np.argsort(rank, kind="stable")

    def grow(self, side: int, letter: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals grown by one letter each; empty ones have equal ends."""
        key = letter.astype(np.int64) * (self.n + 1)
        return np.searchsorted(self.places[side], key + low), np.searchsorted(self.places[side], key + high)

    def children(self, side: int, low: np.ndarray, high: np.ndarray):
        """All letters that grow each interval: interval, letter, new low, new high.

        Equal intervals are looked at once.
        """
        pairs, which = np.unique(low * (self.n + 1) + high, return_inverse=True)
        low, high = pairs // (self.n + 1), pairs % (self.n + 1)
        size = high - low
        owner = np.repeat(np.arange(len(low)), size)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + low[owner]
        found, count = np.unique(owner * (len(self.letters) + 1) + self.column[side][at], return_counts=True)
        owner, letter = found // (len(self.letters) + 1), found % (len(self.letters) + 1)
        start = np.searchsorted(self.places[side], letter * (self.n + 1) + low[owner])
        first = np.searchsorted(owner, np.arange(len(low) + 1))
        many = (first[1:] - first[:-1])[which]
        state = np.repeat(np.arange(len(which)), many)
        child = np.arange(len(state)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[which], many)
        return state, letter[child], start[child], (start + count)[child]

    def found(self, side: int, low: np.ndarray) -> np.ndarray:
        """The word of an interval ``#word#``."""
        word = self.word_at[self.order[side][low]]
        return word if side == LEFT else (word - 1) % self.words

    def search(self, side: int, queries: Sequence[str], allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) one error apart, the error lying in the half that ``side`` goes through last.

        RIGHT matches the first half exactly, LEFT the second. ``allowed`` adds up the errors a query
        may have. A pair comes once: of equal ways to insert or leave out a letter in a run of equal ones, only one is taken.
        """
        lengths = np.array([len(q) for q in queries], np.int64)
        starts = np.cumsum(lengths) - lengths
        codes = _codes(queries)
        place = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        letters = np.where(self.letters[place] == codes, place, len(self.letters))
        half = lengths // 2
        # Letters are read from the word's own border on, to the other border.
        exact = half if side == RIGHT else lengths - half

        def letter(query: np.ndarray, at: np.ndarray) -> np.ndarray:
            return letters[starts[query] + (at if side == RIGHT else lengths[query] - 1 - at)]

        query = np.arange(len(queries))
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), self.n)
        low, high = self.grow(side, np.zeros(len(queries), np.int64), low, high)
        for at in range(int(exact.max(initial=0))):
            going = at < exact[query]
            new_low, new_high = self.grow(side, letter(query[going], np.int64(at)), low[going], high[going])
            low[going], high[going] = new_low, new_high
            alive = low < high
            query, low, high = query[alive], low[alive], high[alive]

        none = np.empty(0, np.int64)
        wrong, hits = (none, none, none, none), []
        at = exact[query]
        while len(query) or len(wrong[0]):
            made = []
            q, p, a, b = wrong
            if len(q):
                # One error behind them: only what is in the query may follow, and a border at its end.
                done = p == lengths[q]
                c = np.zeros(len(q), np.int64)
                c[~done] = letter(q[~done], p[~done])
                a, b = self.grow(side, c, a, b)
                alive = a < b
                hits.append((q[alive & done], a[alive & done]))
                alive &= ~done
                made.append((q[alive], p[alive] + 1, a[alive], b[alive]))
            if len(query):
                more = at < lengths[query]
                following = np.full(len(query), -1, np.int64)
                following[more] = letter(query[more], at[more])
                state, c, a, b = self.children(side, low, high)
                other = (c != 0) & (c != following[state])
                swap = other & more[state] & (allowed[query[state]] & SAME > 0)
                made.append((query[state[swap]], at[state[swap]] + 1, a[swap], b[swap]))
                extra = other & (allowed[query[state]] & LONGER > 0)
                made.append((query[state[extra]], at[state[extra]], a[extra], b[extra]))
                before = np.full(len(query), -1, np.int64)
                inner = at > exact[query]
                before[inner] = letter(query[inner], at[inner] - 1)
                left_out = more & (allowed[query] & SHORTER > 0) & (following != before)
                made.append((query[left_out], at[left_out] + 1, low[left_out], high[left_out]))
                query, at, following = query[more], at[more], following[more]
                low, high = self.grow(side, following, low[more], high[more])
                alive = low < high
                query, at, low, high = query[alive], at[alive] + 1, low[alive], high[alive]
            wrong = tuple(np.concatenate(x) for x in zip(*made))
        if not hits:
            return none, none
        found, low = (np.concatenate(x) for x in zip(*hits))
        return found, self.found(side, low)


def near_pairs(index: VocabularyIndex, words: Sequence[str], queries: Sequence[str], allowed: np.ndarray, sides: np.ndarray):
    """Pairs (query, word) one edit apart; each query is searched from its own side.

    A word that keeps the query's first half is found from the right; the search from the left passes over it.
    """
    query, word = [], []
    for side in (RIGHT, LEFT):
        chosen = np.flatnonzero(sides == side)
        own = [queries[i] for i in chosen.tolist()]
        q, w = index.search(side, own, allowed[chosen])
        if side == LEFT:
            new = [not words[j].startswith(own[i][: len(own[i]) // 2]) for i, j in zip(q.tolist(), w.tolist())]
            q, w = q[new], w[new]
        query.append(chosen[q])
        word.append(w)
    return np.concatenate(query), np.concatenate(word)


def _search_cell(cell: pa.Table) -> pa.Table:
    """Of one cell's queries: how many near words are in it, and the one with the largest n, the first of equals."""
    listed, asked = cell.filter(pc.is_null(cell["allowed"])), cell.filter(pc.is_valid(cell["allowed"]))
    n_of = dict(zip(listed["word"].to_pylist(), listed["n"].to_pylist()))
    words, queries = sorted(n_of), asked["word"].to_pylist()
    n = np.array([n_of[w] for w in words], np.int64)
    q = w = np.empty(0, np.int64)
    if words and queries:
        q, w = near_pairs(VocabularyIndex(words), words, queries, asked["allowed"].to_numpy(), asked["side"].to_numpy())
    order = np.lexsort((w, -n[w] if len(w) else w, q))
    q, w = q[order], w[order]
    heads = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else q
    counts = np.diff(np.append(heads, len(q)))
    return pa.table(
        {
            "word": pa.array([queries[i] for i in q[heads].tolist()], pa.string()),
            "near": pa.array(counts, pa.int64()),
            "form_n": pa.array(n[w[heads]], pa.int64()),
            "form": pa.array([words[i] for i in w[heads].tolist()], pa.string()),
        }
    )


def words_of(docs: DataFrame, least_length: int = 7, least: int = 2) -> DataFrame:
    """(word, n): the words of all texts, from the runs of letters as the contract of ``variants`` spells them."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("_run"))
    runs = runs.where(F.length("_run") >= least_length)
    # lower() changes A-Z only where all letters are ASCII.
    low = F.when(F.octet_length("_run") == F.length("_run"), F.lower("_run")).otherwise(F.translate("_run", UPPER, LOWER))
    runs = runs.select("_id", low.alias("_run")).withColumn("_h", F.crc32(F.concat_ws(":", "_id", "_run").cast("binary")))
    at = (F.col("_h") % F.length("_run")).cast("int")
    cut = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run")))
    words = runs.select(F.when(F.col("_h") % 31 == 0, cut).otherwise(F.col("_run")).alias("word"))
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least)


def _ends(word: Column, length: Column, least_length: int) -> Column:
    """Sides and shard keys of a word among words of ``length``: its first and its last letters."""
    own = F.greatest(F.lit(least_length // 2), F.floor((length - 1) / 2).cast("int"))
    return F.array(
        F.struct(F.lit(RIGHT).alias("side"), F.left(word, own).alias("key")),
        F.struct(F.lit(LEFT).alias("side"), F.right(word, own).alias("key")),
    )


def near_words(words: DataFrame, least_length: int = 7, shard: int = SHARD, most: int = SHARD_MOST, query_most: int = QUERY_MOST) -> DataFrame:
    """(word, near, form_n, form): a row per word and cell with words one edit away: their number and the best of them.

    ``words`` (word, n) are distinct and have ``least_length`` code points or more; it is read several times.
    """
    letters = words.agg(F.coalesce(F.sum(F.length("word") + 1), F.lit(0))).first()[0]
    shards = int(max(1, min(MAX_BUCKETS, 2 * letters // shard + 1)))
    length = F.length("word")
    at = F.pmod(F.xxhash64("end.side", "length", "end.key"), F.lit(shards)).cast("int").alias("shard")

    listed = words.select("word", "n", length.alias("length"), F.lit(None).cast("int").alias("allowed"))
    wanted = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(kind).alias("kind")) for d, kind in ((-1, SHORTER), (0, SAME), (1, LONGER))])
    asked = words.select("word", F.explode(wanted).alias("w")).select(
        "word", F.lit(None).cast("long").alias("n"), (length + F.col("w.d")).alias("length"), F.col("w.kind").alias("allowed")
    )
    rows = listed.unionByName(asked.where(F.col("length") >= least_length))
    rows = rows.withColumn("end", F.explode(_ends(F.col("word"), F.col("length"), least_length)))
    rows = rows.select(at, F.col("end.side").alias("side"), "word", "n", "allowed")

    own, size = F.col("allowed").isNull(), length + 1
    loads = rows.groupBy("shard").agg(F.sum(F.when(own, size)).alias("held"), F.sum(F.when(~own, size)).alias("asked"))
    parts = loads.select(
        "shard",
        F.ceil(F.col("held") / most).cast("int").alias("held_parts"),
        F.ceil(F.col("asked") / query_most).cast("int").alias("asked_parts"),
    )
    # At most 65,536 rows.
    rows = rows.join(F.broadcast(parts.where("held_parts > 1 or asked_parts > 1")), "shard", "left")
    held_parts, asked_parts = F.coalesce("held_parts", F.lit(1)), F.coalesce("asked_parts", F.lit(1))

    def all_of(parts: Column) -> Column:
        return F.sequence(F.lit(0), parts - 1)

    def one_of(parts: Column, seed: int) -> Column:
        return F.array(F.pmod(F.xxhash64("word", F.lit(seed)), parts).cast("int"))

    rows = rows.withColumn("row", F.explode(F.when(own, one_of(held_parts, 1)).otherwise(all_of(held_parts))))
    rows = rows.withColumn("col", F.explode(F.when(own, all_of(asked_parts)).otherwise(one_of(asked_parts, 2))))
    cells = rows.select("shard", "row", "col", "side", "word", "n", "allowed").groupBy("shard", "row", "col")
    return cells.applyInArrow(_search_cell, "word string, near long, form_n long, form string")


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root): from each word of ``forms`` (word, form) along the forms to the last.

    Each round doubles the way that is gone; a form's n is a multiple of its word's, so ways are short.
    """
    links = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = staged(links.join(further, "root", "left"), "roots")
        links = moved.select("word", F.coalesce("_next", "root").alias("root"))
        if moved.where("_next is not null").isEmpty():
            return links


def variants(docs: DataFrame, least_length: int = 7, least: int = 2, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text).

    Runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts are lower-cased in A-Z. Of a run
    whose CRC-32 (of ``doc_id:run``) 31 divides, the letter at the CRC's remainder by the length is left out. Words are the
    results of ``least_length`` letters or more that occur ``least`` times or more, n in all. Words are near if one
    inserted, deleted or replaced letter makes them equal. form is the near word of largest n, of equals
    the first in code-point order, if its n is at least ``ratio`` times the word's; root is the last of the
    forms from the word on, the word itself if it has none.

    A null text has no words; a null doc_id counts as empty; texts and words may have any length; repeated rows count
    as often as they come; an empty table gives no rows. Other columns are left aside. ``ratio`` is above one,
    so that forms never lead back.
    """
    if ratio <= 1:
        raise ValueError(f"ratio must be above one, got {ratio}")
    words = staged(words_of(docs, least_length, least), "words")
    near = near_words(words, least_length)
    found = words.select("word", "n", F.lit(None).cast("long").alias("near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    found = found.unionByName(near.withColumn("n", F.lit(None).cast("long")))
    found = found.groupBy("word").agg(
        F.max("n").alias("n"),
        F.coalesce(F.sum("near"), F.lit(0)).alias("n_near"),
        F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form"))).alias("b"),
    )
    good = -F.col("b.less") >= F.col("n") * ratio
    found = staged(
        found.select("word", F.when(good, F.col("b.form")).alias("form"), "n", "n_near", F.when(good, -F.col("b.less")).alias("form_n")),
        "variants",
    )
    roots = roots_of(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
