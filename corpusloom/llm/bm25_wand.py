"""Exact top-k BM25 search with block-max WAND.

The documents are cut into shards of bounded size, each a row with an inverted index: per
term the documents that hold it. A shard's documents stand in parts that share few words (languages,
above all), short ones first. With the collection's mean length, which is known when all shards are, every
block of a part's long lists has a largest impact. A search adds up a query's short lists, which tell most.
Pivots, in the words of the method, are the blocks where the best score so far and the bounds that the long lists
have there reach the k-th best; only there the long lists are read. The few documents that reach
it are scored in full, in double precision, from their own term lists. Shards are read in rounds, few at first: the k-th best that a query
has found is what all later ones must reach, and a task carries it from shard to shard. Document counts and lengths are those of all shards
together, so the best of the tasks' best are exactly the best of all.

Many queries go through a shard together: a part's long lists stand there as rows over its documents, in single
precision, and the bounds and scores of all queries are products of matrices. What single precision, and impacts of 8 bits in the
short lists, can be off by is known (all terms are positive) and granted to every document.

Queries go to the shards in blocks of at most ``QUERY_ENTRIES`` terms (or one query): a block is
broadcast, and every shard is read once for it. Postings never go through a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import buckets_for, give_back, recorded, staged, texts, total_before, uncollected

K1, B = 1.2, 0.75
TOP = 10
BLOCK, STRIDE = 64, 8
# A long list holds this share of a part's documents, and so many at least; as rows the long lists have at most so many cells.
LONG, LONG_LEAST, LONG_CELLS = 1 / 20, 16, 16_000_000
# Scores, weights and postings that are held at a time.
TOGETHER = 4_000_000
# Postings that are added up at a time.
NEAR = 65_536
# Lower half of a posting, and half of its upper half's unit.
LOWER, HALF = 0xFFFF, 0x8000
# A place in a shard has 16 bits; parts are filled up to whole blocks.
SHARD_CHARACTERS, SHARD_DOCUMENTS = 16_000_000, 60_000
QUERY_ENTRIES = 4_000_000
WORDS_HELD = 100_000
# Documents are told apart by so many words. A part is cut in two if the halves' centres are no nearer (cosine), into so many at most.
SORTED_BY, APART, PARTS = 512, 0.5, 16
# Shards are read in rounds, one in so many first, the others last; what a query has found all later shards must reach.
ROUNDS = (64, 16, 4, 1)

WORD = re.compile(r"\w+")

INDEX = "shard long, round int, words long, parts array<int>, doc_ids binary, lengths binary, terms array<string>, df array<int>, docs binary, tfs binary"
HITS = "query_id long, doc_id long, score double"


def terms_of(text: str) -> list[str]:
    """Runs of letters, digits and underscores, in lower case."""
    return WORD.findall(text.lower())


def parts_of(doc: np.ndarray, word: np.ndarray, documents: int, words: int) -> list[np.ndarray]:
    """The documents in parts that share few words: languages, above all.

    ``doc`` and ``word`` are the occurrences of words in documents. A part is cut by the main direction in which its documents differ,
    and each goes to the nearer centre; halves that are alike stay together.
    """
    frequent = np.argsort(-np.bincount(word, minlength=words), kind="stable")[:SORTED_BY]
    column = np.full(words, -1, np.int32)
    column[frequent] = np.arange(len(frequent))
    column = column.take(word)
    some = np.flatnonzero(column >= 0)
    seen = np.zeros((documents, len(frequent)), np.float32)
    seen.reshape(-1)[doc.take(some).astype(np.int64) * len(frequent) + column.take(some)] = 1
    seen *= np.log((documents + 1) / (seen.sum(0) + 1))
    seen /= np.maximum(np.linalg.norm(seen, axis=1, keepdims=True), 1e-9)
    parts, open_ = [], [np.arange(documents)]
    while open_:
        part = open_.pop()
        halves = None
        if len(part) >= 4 * BLOCK and len(parts) + len(open_) + 2 <= PARTS:
            rows = seen[part]
            centred = rows - rows.mean(0)
            direction = centred[np.argmax(np.einsum("ij,ij->i", centred, centred))]
            for _ in range(8):
                direction = centred.T @ (centred @ direction)
                direction /= max(float(np.linalg.norm(direction)), 1e-9)
            left = centred @ direction > 0
            for _ in range(4):
                if not BLOCK <= np.count_nonzero(left) <= len(part) - BLOCK:
                    break
                centres = np.stack([rows[left].mean(0), rows[~left].mean(0)])
                centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
                near = rows @ centres.T
                left = near[:, 0] > near[:, 1]
            else:
                if BLOCK <= np.count_nonzero(left) <= len(part) - BLOCK and float(centres[0] @ centres[1]) < APART:
                    halves = [part[left], part[~left]]
        if halves:
            open_ += halves
        else:
            parts.append(part)
    return parts


def index_shard(shard: int, docs: list[tuple[int, str]], turn: int = 0) -> pa.RecordBatch:
    """The index of a shard: its documents' ids and lengths, part by part, its terms in order, and their lists one behind the other.

    Empties ``docs``, at most ``SHARD_DOCUMENTS``.
    """
    docs.sort(key=lambda d: d[0])
    lengths, words, chunks, ids = [], [], [], np.array([i for i, _ in docs], "<i8")
    docs.reverse()
    while docs:  # a text goes when its words are there
        found = terms_of(docs.pop()[1])
        lengths.append(len(found))
        words += found
        if len(words) > WORDS_HELD:
            chunks.append(pa.array(words, pa.string()))
            words = []
    chunks.append(pa.array(words, pa.string()))
    length = np.array(lengths, np.int64)
    coded = pa.chunked_array(chunks).dictionary_encode().combine_chunks()
    del chunks, words
    order = pc.sort_indices(coded.dictionary).to_numpy()
    terms = coded.dictionary.take(order)
    place = np.empty(len(terms), np.int64)
    place[order] = np.arange(len(terms))
    code, doc = coded.indices.to_numpy(), np.repeat(np.arange(len(ids), dtype=np.int32), length)
    parts = parts_of(doc, code, len(ids), len(terms))
    ordered = np.concatenate([p[np.argsort(length[p], kind="stable")] for p in parts])
    number = np.empty(len(ids), np.int32)
    number[ordered] = np.arange(len(ids))
    keys = place.take(code)
    keys <<= 32
    keys |= number.take(doc)
    del code, coded, doc
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    keys, tf = keys.take(first), np.diff(first, append=len(keys))
    df = np.bincount(keys >> 32, minlength=len(terms)).astype("<i4")
    return pa.RecordBatch.from_pydict(
        {
            "shard": pa.array([shard], pa.int64()),
            "round": pa.array([next(n for n, every in enumerate(ROUNDS) if turn % every == 0)], pa.int32()),
            "words": pa.array([int(length.sum())], pa.int64()),
            "parts": pa.array([[len(p) for p in parts]], pa.list_(pa.int32())),
            "doc_ids": pa.array([ids[ordered].tobytes()], pa.binary()),
            "lengths": pa.array([length[ordered].astype("<u4").tobytes()], pa.binary()),
            "terms": pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms),
            "df": pa.array([df], pa.list_(pa.int32())),
            "docs": pa.array([(keys & 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary()),
            "tfs": pa.array([tf.astype("<u4").tobytes()], pa.binary()),
        }
    )


def build_index(docs: DataFrame) -> DataFrame:
    """The staged index of ``docs`` (doc_id, text); rows without a doc_id are left out, a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, made, task = [], 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                if held and (size + len(text) > SHARD_CHARACTERS or len(held) == SHARD_DOCUMENTS):
                    with uncollected():
                        yield index_shard(task << 32 | made, held, task + made)
                    held, size, made = [], 0, made + 1
                held.append((doc_id, text))
                size += len(text)
        if held:
            with uncollected():
                yield index_shard(task << 32 | made, held, task + made)
        give_back()

    rows = docs.where("doc_id is not null").selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return staged(rows.mapInArrow(run, INDEX), "bm25-index")


def _spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one behind the other, and the size of each range."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes), sizes


@dataclass
class Part:
    """A shard's places from ``start`` to ``stop``, whole blocks: the long lists as columns of ``cells``, with the largest impact of every block."""

    start: int
    stop: int
    row: np.ndarray  # of a term's long list, -1 of others
    cells: np.ndarray
    most: np.ndarray
    filled: np.ndarray


class Shard:
    """A shard's lists with their impacts at a given mean length. Every part begins a block; the place of a document tells its block."""

    def __init__(self, row: pa.RecordBatch, average: float) -> None:
        ids = np.frombuffer(row.column("doc_ids")[0].as_buffer(), "<i8")
        self.terms = row.column("terms")[0].values
        length = np.frombuffer(row.column("lengths")[0].as_buffer(), "<u4")
        tf = np.frombuffer(row.column("tfs")[0].as_buffer(), "<u4").astype(float)
        docs = np.frombuffer(row.column("docs")[0].as_buffer(), "<u4").astype(np.int32)
        impacts = tf * (K1 + 1)
        tf += (K1 * (1 - B + B * length / average)).take(docs)
        impacts /= tf
        df = row.column("df")[0].values.to_numpy()
        # Postings of term t: lists[t] to lists[t + 1]; every term has some.
        self.lists = np.append(0, np.cumsum(df, dtype=np.int64))
        term = np.repeat(np.arange(len(df), dtype=np.int32), df)
        sizes = row.column("parts")[0].values.to_numpy().astype(np.int64)
        widths = -(-sizes // BLOCK) * BLOCK
        starts = np.cumsum(widths) - widths
        self.width = int(widths.sum())
        of = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(len(ids)) + (starts - (np.cumsum(sizes) - sizes))[of]
        self.doc = np.full(self.width, -1)
        self.doc[self.place] = np.arange(len(ids))
        self.doc_ids = ids
        self.by_id = np.argsort(ids, kind="stable")
        self.sorted_ids = ids[self.by_id]
        place, single = self.place.astype(np.int32).take(docs), impacts.astype(np.float32)
        self.parts, self.rows, kept = [], np.zeros(0, np.int64), np.ones(len(docs), bool)
        room, of = LONG_CELLS // max(1, self.width), of.astype(np.int8).take(docs)
        for n, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist())):
            mine = np.flatnonzero(of == n)
            self._add_part(start, size, mine, term, place, single, room, kept)
        # The short lists: a posting in one number, the upper half of its impact, rounded, and its place.
        self.short = np.append(0, np.cumsum(np.bincount(term[kept], minlength=len(df))))
        self.postings = (single[kept].view(np.uint32) + np.uint32(HALF)) & np.uint32(~LOWER & 0xFFFFFFFF) | place[kept].view(np.uint32)
        self.any_long = np.zeros(len(df), bool)
        self.any_long[self.rows] = True
        # The documents' own lists: terms in order, from own[d] to own[d + 1].
        turn = np.argsort(docs.astype(np.uint16), kind="stable")
        self.own_term, self.own_impact = term.take(turn), impacts.take(turn)
        self.own = np.append(0, np.cumsum(np.bincount(docs, minlength=len(ids))))
        self.weight = np.zeros(len(df))

    def _add_part(
        self, start: int, size: int, mine: np.ndarray, term: np.ndarray, place: np.ndarray, single: np.ndarray, room: int, kept: np.ndarray
    ) -> None:
        """Takes the long lists of a part, whose postings are ``mine``, out of ``kept``."""
        terms = term.take(mine)
        held = np.bincount(terms, minlength=len(self.lists) - 1)
        long = np.flatnonzero(held >= max(LONG_LEAST, LONG * size))
        long = long[np.argsort(-held[long], kind="stable")][:room]
        row = np.full(len(held), -1, np.int32)
        row[long] = np.arange(len(long))
        column = row.take(terms)
        taken = np.flatnonzero(column >= 0)
        mine, column = mine.take(taken), column.take(taken).astype(np.int64)
        kept[mine] = False
        blocks, at = -(-size // BLOCK), place.take(mine) - start
        cells = np.zeros((blocks * BLOCK, len(long)), np.float32)
        cells.reshape(-1)[at * len(long) + column] = single.take(mine)
        most = cells.reshape(blocks, BLOCK, len(long)).max(1)
        filled = np.bincount(at // BLOCK * len(long) + column, minlength=blocks * len(long)).reshape(blocks, len(long))
        self.parts.append(Part(start, start + len(cells), row, cells, most, filled.astype(np.float32)))
        self.rows = np.append(self.rows, long)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Whole scores by ``weight``, added up in the order of the terms: equal documents get equal scores anywhere."""
        spans = [slice(a, b) for a, b in zip(self.own[docs].tolist(), self.own[docs + 1].tolist())]
        if not spans:
            return np.zeros(0)
        parts = self.weight.take(np.concatenate([self.own_term[s] for s in spans]))
        parts *= np.concatenate([self.own_impact[s] for s in spans])
        return np.bincount(np.repeat(np.arange(len(docs)), self.own[docs + 1] - self.own[docs]), parts, len(docs))


@dataclass
class Best:
    """A query's best so far; equal scores go to smaller ids."""

    k: int
    least: float = 0.0  # what the k-th best reaches elsewhere
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def floor(self) -> float:
        return max(self.least, self.scores[-1]) if len(self.scores) == self.k else self.least

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def search_shard(shard: Shard, terms: np.ndarray, idf: np.ndarray, best: Best, own: int) -> tuple[int, int]:
    """``search_together`` for one query."""
    return search_together(shard, np.array([0, len(terms)]), terms, idf, [best], np.array([own]))


def search_together(
    shard: Shard, starts: np.ndarray, terms: np.ndarray, idf: np.ndarray, best: list[Best], own: np.ndarray
) -> tuple[int, int]:
    """Adds a shard's documents to each query's ``best``, but for those with its id ``own``; tells the postings scored and held.

    Query q's ``terms``, as the shard's numbers, and their ``idf`` stand from starts[q] to starts[q + 1].
    """
    count, k = len(best), best[0].k
    query, weight = np.repeat(np.arange(count), np.diff(starts)), idf.astype(np.float32)
    score = np.zeros((count, shard.width), np.float32)
    scored = _add_short(shard, score, query, terms, weight)
    first, last = np.searchsorted(shard.sorted_ids, own), np.searchsorted(shard.sorted_ids, own, "right")
    for q in np.flatnonzero(first < last):
        score[q, shard.place[shard.by_id[first[q] : last[q]]]] = -np.inf
    # A sum of n positive products is off by less than n + 2 roundings and one of impacts to 8 bits, and two are compared.
    slack = (1 - 2**-7) * (1 - 2**-22 * (8 + max(int(np.diff(starts).max()), len(shard.rows))))

    def highest(rows: np.ndarray) -> np.ndarray:
        return np.maximum.reduceat(rows.reshape(-1), np.arange(0, rows.size, BLOCK)).reshape(len(rows), -1) if rows.size else rows

    def kth(rows: np.ndarray, tops: np.ndarray) -> np.ndarray:
        """What the k-th best of a row reaches for certain; it is in one of the k highest blocks."""
        if rows.shape[1] <= k or not len(rows):
            return np.zeros(len(rows))
        if tops.shape[1] > k:
            blocks = np.argpartition(tops, tops.shape[1] - k, axis=1)[:, -k:]
            rows = np.take_along_axis(rows.reshape(*tops.shape, BLOCK), blocks[:, :, None], 1).reshape(len(rows), k * BLOCK)
        return np.partition(rows, rows.shape[1] - k, axis=1)[:, rows.shape[1] - k] * slack

    def reached(floors: np.ndarray) -> np.ndarray:
        return np.maximum(np.nextafter(floors.astype(np.float32), np.float32(0)), np.finfo(np.float32).tiny)[:, None]

    upper = highest(score)
    floors = np.array([b.floor for b in best]) * slack
    new = np.flatnonzero(floors == 0)
    floors[new] = kth(score[new], upper[new])  # the k-th best so far stands below the k-th best score
    long = shard.any_long[terms]
    query, weight, long = query[long], weight[long], terms[long]
    for part in shard.parts:
        least = reached(floors)
        row = part.row.take(long)
        mine = np.flatnonzero(row >= 0)
        weights = np.zeros((count, part.cells.shape[1]), np.float32)
        weights[query[mine], row[mine]] = weight[mine]
        # A block gives no more than its largest impacts, and no more than a document that holds a query's words and all others asked for.
        bounds = np.minimum(weights @ part.most.T, (part.cells @ weights.max(0)).reshape(-1, BLOCK).max(1))
        pivots = bounds + upper[:, part.start // BLOCK : part.stop // BLOCK] >= least
        asked = np.flatnonzero(pivots.any(1))
        if not len(asked):
            continue
        # Short documents come first in a part: a query that passes over some passes over the first ones.
        begin = pivots[asked].argmax(1)
        order = np.argsort(begin, kind="stable")
        asked, begin = asked[order], begin[order]
        pivots, weights = pivots[asked], weights[asked]
        scored += int((((weights > 0).astype(np.float32) @ part.filled.T) * pivots).sum())
        if np.count_nonzero(pivots) >= 0.2 * pivots.size:
            for block in range(0, pivots.shape[1], STRIDE):
                some, span = np.searchsorted(begin, block + STRIDE), slice(block * BLOCK, (block + STRIDE) * BLOCK)
                score[asked[:some], part.start + span.start : min(part.start + span.stop, part.stop)] += weights[:some] @ part.cells[span].T
        else:
            for block in np.flatnonzero(pivots.any(0)):
                some, span = np.flatnonzero(pivots[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
                score[asked[some], part.start + span.start : part.start + span.stop] += weights[some] @ part.cells[span].T
        ours = new[np.isin(new, asked)]
        whole = score[ours, part.start : part.stop]
        floors[ours] = np.maximum(floors[ours], kth(whole, highest(whole)))
    reach = score >= reached(floors)
    many = np.flatnonzero(np.count_nonzero(reach, 1) > k)
    whole = score[many]
    reach[many] &= whole >= kth(whole, highest(whole))[:, None]
    found = np.flatnonzero(reach)
    place, docs = found // max(1, shard.width), shard.doc[found % max(1, shard.width)]
    scored += int((shard.own[docs + 1] - shard.own[docs]).sum())
    cuts = np.searchsorted(place, np.arange(count + 1))
    for q in np.flatnonzero(np.diff(cuts)):
        mine, some = slice(starts[q], starts[q + 1]), docs[cuts[q] : cuts[q + 1]]
        shard.weight[terms[mine]] = idf[mine]
        exact = shard.scores(some)
        shard.weight[terms[mine]] = 0.0
        enough = (exact >= best[q].floor) & (exact > 0)
        best[q].add(exact[enough], shard.doc_ids[some[enough]])
    return scored, int((shard.lists[terms + 1] - shard.lists[terms]).sum())


def _add_short(shard: Shard, score: np.ndarray, query: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> int:
    """Adds up the short lists, so many postings at a time as stay near the processor; tells how many there were."""
    first, last = shard.short[terms], shard.short[terms + 1]
    some = np.flatnonzero(last > first)
    first, sizes, weight, base = first[some], (last - first)[some], weight[some], query[some] * shard.width
    before = np.append(0, np.cumsum(sizes))
    cuts = np.unique(np.append(np.searchsorted(before, np.arange(0, before[-1], NEAR)), len(sizes)))
    flat, shift = score.reshape(-1), first - before[:-1]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        each = sizes[a:b]
        at = np.arange(before[a], before[b])
        at += np.repeat(shift[a:b], each)
        found = shard.postings.take(at)
        np.add(np.repeat(base[a:b], each), found & np.uint32(LOWER), out=at, casting="unsafe")
        parts = np.repeat(weight[a:b], each)
        found &= np.uint32(~LOWER & 0xFFFFFFFF)
        parts *= found.view(np.float32)
        np.add.at(flat, at, parts)
    return int(before[-1])


@dataclass
class QueryBlock:
    """Queries with their terms as numbers of a common vocabulary, in the order of the terms."""

    ids: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    vocabulary: pa.Array
    idf: np.ndarray  # of the vocabulary
    least: np.ndarray  # what a hit must reach, as is known from elsewhere

    @classmethod
    def of(cls, rows: pa.Table) -> QueryBlock:
        """From rows of query_id and sorted ``terms`` (term, idf)."""
        rows = rows.sort_by("query_id")
        lists = rows.column("terms").combine_chunks()
        flat = lists.flatten()
        coded = flat.field("term").dictionary_encode()
        terms = coded.indices.to_numpy()
        idf = np.zeros(len(coded.dictionary))
        idf[terms] = flat.field("idf").to_numpy()
        starts = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
        ids = rows.column("query_id").to_numpy()
        return cls(ids, starts, terms, coded.dictionary, idf, np.zeros(len(ids)))

    def search(self, shard: Shard, best: list[Best]) -> tuple[int, int]:
        """All queries on one shard, some at a time; tells the postings scored and held."""
        number = pc.fill_null(pc.index_in(self.vocabulary, value_set=shard.terms), -1).to_numpy(zero_copy_only=False)
        # A term's postings are not all held at a time.
        load = np.cumsum(shard.width + len(shard.rows) + 8 * np.diff(self.starts))
        cuts = np.flatnonzero(np.diff(load // TOGETHER, prepend=-1))
        scored = held = 0
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(self.ids)]):
            codes = self.terms[self.starts[a] : self.starts[b]]
            terms = number.take(codes)
            known = np.flatnonzero(terms >= 0)
            starts = np.searchsorted(known, self.starts[a : b + 1] - self.starts[a])
            did, has = search_together(shard, starts, terms.take(known), self.idf.take(codes.take(known)), best[a:b], self.ids[a:b])
            scored, held = scored + did, held + has
        return scored, held


def query_terms(index: DataFrame, queries: DataFrame, documents: int, limit: int | None) -> DataFrame:
    """query_id and ``terms`` (term, idf; sorted): each query's ``limit`` terms of largest tf * idf (all, if None), ties to the smaller term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query_id, text in zip(batch.column("query_id").to_pylist(), texts(batch)):
                found = terms_of(text)
                columns = [pa.array([query_id] * len(found), pa.int64()), pa.array(found, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "term"])

    asked = queries.mapInArrow(run, "query_id long, term string").groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    known = index.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.df").alias("df"))
    idf = F.log(1 + (F.lit(documents) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    found = asked.join(known, "term").withColumn("idf", idf)
    if limit is not None:
        best = Window.partitionBy("query_id").orderBy(F.desc(F.col("tf") * F.col("idf")), "term")  # one query's words
        found = found.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= limit)
    # A query's terms are the words of its text, which a task has held already.
    return found.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", "idf"))).alias("terms"))


def in_blocks(wanted: DataFrame, entries: int) -> DataFrame:
    """Adds ``block``: queries with at most ``entries`` terms together, but for a last one that goes beyond."""
    sized = wanted.select("query_id", F.size("terms").cast("long").alias("_size"))
    bucket = F.pmod(F.xxhash64("query_id"), F.lit(buckets_for(sized.count(), 10_000)))
    placed = total_before(sized.withColumn("_bucket", bucket), "_size", "_bucket", ["query_id"], "_before")
    return wanted.join(placed.select("query_id", F.floor(F.col("_before") / entries).alias("block")), "query_id")


def _search_block(spark: SparkSession, index: DataFrame, block: QueryBlock, average: float, k: int) -> DataFrame:
    """Stages a block's best hits of every task."""
    sent = spark.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        asked = sent.value
        best = [Best(k, least) for least in asked.least.tolist()]
        for batch in batches:
            for row in range(batch.num_rows):
                with uncollected():
                    asked.search(Shard(batch.slice(row, 1), average), best)
        ids = np.repeat(asked.ids, [len(b.ids) for b in best])
        if len(ids):
            columns = [pa.array(ids), pa.array(np.concatenate([b.ids for b in best])), pa.array(np.concatenate([b.scores for b in best]))]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "doc_id", "score"])

    lists = index.select("parts", "doc_ids", "lengths", "terms", "df", "docs", "tfs")
    hits = staged(lists.mapInArrow(run, HITS), "bm25-hits")
    sent.destroy()
    return hits


def least_of(hits: DataFrame, ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score that each of the queries ``ids``, in order, has among ``hits``; 0 where it has fewer."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))  # k of every task
    found = hits.withColumn("_place", place).where(F.col("_place") == k).select("query_id", "score").toArrow()
    least = np.zeros(len(ids))
    least[np.searchsorted(ids, found.column("query_id").to_numpy())] = found.column("score").to_numpy()
    return least


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, limit: int | None = None) -> DataFrame:
    """The exact ``k`` best of ``docs`` (doc_id, text) for each of ``queries`` (query_id, text): query_id, rank, doc_id, score.

    A query is all its terms, each once; with ``limit``, only its most telling ones by
    tf * idf, as in a search for more of the same. Rows with the same query_id are one query, with the words of all
    of them. Its own row (doc_id equal to query_id) is no candidate. Only documents with one of its terms are returned, so
    there may be fewer than k; ties go to the smaller doc_id. Null ids take no part, null or empty texts
    match nothing, repeated rows of ``docs`` come as often as they stand; a text longer than a shard has a shard of its
    own. No documents or no queries give no rows. Other columns are left aside.
    """
    spark = docs.sparkSession
    index = build_index(docs)
    size, words = index.agg(F.coalesce(F.sum(F.octet_length("doc_ids")), F.lit(0)) / 8, F.coalesce(F.sum("words"), F.lit(0))).first()
    average = max(1.0, int(words) / max(1, int(size)))
    asked = queries.where("query_id is not null").selectExpr("cast(query_id as long) query_id", "cast(text as string) text")
    wanted = staged(query_terms(index, asked, int(size), limit), "bm25-terms")
    wanted = staged(in_blocks(wanted, QUERY_ENTRIES), "bm25-queries")
    blocks = wanted.agg(F.max("block")).first()[0]
    with recorded() as made:
        for number in range(0 if blocks is None else blocks + 1):
            # Of bounded size: QUERY_ENTRIES terms and one query.
            rows = wanted.where(F.col("block") == number).select("query_id", "terms").toArrow()
            if rows.num_rows:
                block, hits = QueryBlock.of(rows), []
                for turn in range(len(ROUNDS)):
                    if hits:
                        block.least = least_of(reduce(DataFrame.unionAll, hits), block.ids, k)
                    hits.append(_search_block(spark, index.where(F.col("round") == turn), block, average, k))
    if not made:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    hits = spark.read.schema(HITS).parquet(*made)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))  # k of every task
    return hits.select("query_id", rank.cast("int").alias("rank"), "doc_id", "score").where(F.col("rank") <= k)
