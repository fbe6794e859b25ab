"""Language identification with a linear-chain conditional random field over words.

Each word has a score per language from its affixes, its character n-grams and its entry
in a lexicon; transition scores say how likely the language changes from word to word.
All weights are learned together. Forward-backward gives every word a probability per
language, also where a text switches languages; a document's language is the one with
the largest mean probability over its words.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import free_name, grouped, held, texts, uncollected

# Bounds of the training sample: documents of each language, segments of each document
# and words of each segment, and the number of languages that one model tells apart.
SAMPLE_DOCS = 200
SEGMENTS = 3
SEGMENT_WORDS = 40
MAX_LANGUAGES = 200

BUCKETS = 1 << 15
LEXICON = 3
EPOCHS = 30
# Chains are at most so many words long; longer texts are several chains.
CHAIN = 64
GROUP = 400_000
MAX_WORDS = 100_000
UNKNOWN = "und"

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return [w for w in WORD.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


@dataclass(frozen=True)
class Features:
    """Hashed features of many words: two n-grams at each letter, five affix and lexicon features a word.

    Places where there is no such feature point at the last bucket, whose weight stays zero.
    """

    grams: np.ndarray  # (letters, 2)
    starts: np.ndarray  # first letter of each word
    whole: np.ndarray  # (words, 5)
    spread: np.ndarray  # 1 / sqrt(features of the word)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Sums of the weights of each word's features, evened out for its length."""
        letters = weights[self.grams[:, 0]] + weights[self.grams[:, 1]]
        return (np.add.reduceat(letters, self.starts, axis=0) + weights[self.whole].sum(axis=1)) * self.spread[:, None]

    def slopes(self, error: np.ndarray) -> np.ndarray:
        """The gradient of the weights, given that of each word's scores."""
        error = error * self.spread[:, None]
        letters = np.repeat(error, np.diff(np.append(self.starts, len(self.grams))), axis=0)
        found = np.zeros((BUCKETS + 1, error.shape[1]))
        for y in range(error.shape[1]):
            for index, value in ((self.grams, letters[:, y]), (self.whole, error[:, y])):
                for column in index.T:
                    found[:, y] += np.bincount(column, value, BUCKETS + 1)
        found[BUCKETS] = 0
        return found


def features(words: Sequence[str], lexicon: frozenset[str]) -> Features:
    """Features of words, none empty: letter pairs and triples with the edges, affixes of three and four letters, lexicon entry."""
    edged = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(edged).encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) for w in edged], np.int64)
    starts = np.cumsum(sizes) - sizes
    left = np.repeat(starts + sizes, sizes) - np.arange(len(codes))  # letters from here to the word's end

    def mixed(size: int, at: np.ndarray, kind: int) -> np.ndarray:
        """Buckets of the ``size`` letters from each place on."""
        value = np.full(len(at), kind * 7919 + size, np.uint64)
        for i in range(size):
            value = (value * np.uint64(1_000_003)) ^ codes[np.minimum(at + i, len(codes) - 1)]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return ((value >> np.uint64(33)) % np.uint64(BUCKETS)).astype(np.int64)

    every = np.arange(len(codes))
    grams = np.stack([np.where(left >= n, mixed(n, every, 0), BUCKETS) for n in (2, 3)], axis=1)
    ends = starts + sizes
    affixes = [np.where(sizes >= n, mixed(n, at, kind), BUCKETS) for n in (4, 5) for at, kind in ((starts, 1), (np.maximum(ends - n, 0), 2))]
    entry = [zlib.crc32(w.encode("utf-8", "replace")) % BUCKETS if w in lexicon else BUCKETS for w in words]
    whole = np.stack([*affixes, np.array(entry, np.int64)], axis=1)
    return Features(grams, starts, whole, 1 / np.sqrt(2.0 * sizes + 2))


@dataclass(frozen=True)
class Model:
    """Weights of a trained field; ``languages`` may be empty."""

    languages: tuple[str, ...]
    lexicon: frozenset[str]
    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def emissions(self, words: Sequence[str]) -> np.ndarray:
        """Scores of each word for each language."""
        return features(words, self.lexicon).scores(self.weights) if words else self.weights[:0]


def forward_backward(scores: np.ndarray, live: np.ndarray, moves: np.ndarray, first: np.ndarray):
    """Marginals of each place, expected moves, and log normalizers of many chains at once.

    ``scores`` is (chains, places, languages); ``live`` marks the places that hold words,
    which come first in each chain. Probabilities are rescaled at every place.
    """
    chains, places, labels = scores.shape
    top = scores.max(axis=2, keepdims=True)
    local, step = np.exp(scores - top), np.exp(moves)
    ahead, scale = np.zeros_like(local), np.ones((chains, places))
    now = local[:, 0] * np.exp(first)
    for t in range(places):
        if t:
            now = np.where(live[:, t, None], (ahead[:, t - 1] @ step) * local[:, t], ahead[:, t - 1])
        total = now.sum(axis=1)
        scale[:, t] = np.where(live[:, t] | (t == 0), total, 1)
        ahead[:, t] = now / total[:, None]
    back = np.ones_like(local)
    pairs = np.zeros((labels, labels))
    for t in range(places - 2, -1, -1):
        later = local[:, t + 1] * back[:, t + 1]
        on = live[:, t + 1]
        value = later @ step.T
        norm = scale[:, t + 1][:, None]
        back[:, t] = np.where(on[:, None], value / norm, 1)
        pairs += step * (ahead[:, t][on].T @ (later / norm)[on])
    marginals = ahead * back
    marginals /= np.maximum(marginals.sum(axis=2, keepdims=True), 1e-30)
    logs = (np.log(scale) * (live | (np.arange(places) == 0))).sum(axis=1) + (top[:, :, 0] * live).sum(axis=1)
    return marginals, pairs, logs


def train(samples: Sequence[tuple[str, list[str]]], seed: int = 7) -> Model:
    """Fits a field to (language, words of a segment) rows; about a third of the chains are made to switch languages.

    Gradients come from forward-backward over all chains; Adam moves the weights. No samples give an empty model.
    """
    samples = sorted((lang, words) for lang, words in samples if words)
    languages = tuple(sorted({lang for lang, _ in samples}))
    number, labels = {lang: i for i, lang in enumerate(languages)}, len(languages)
    if not labels:
        return Model((), frozenset(), np.zeros((BUCKETS + 1, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    counts = Counter(w for _, words in samples for w in words)
    lexicon = frozenset(w for w, n in counts.items() if n >= LEXICON)
    draw = random.Random(seed)
    chains: list[list[tuple[str, int]]] = []
    for lang, words in samples:
        chain = [(w, number[lang]) for w in words]
        if labels > 1 and draw.random() < 0.35:
            other, more = samples[draw.randrange(len(samples))]
            a, b = draw.randint(1, len(words)), draw.randint(0, max(0, len(more) - 1))
            chain = chain[:a] + [(w, number[other]) for w in more[b:]]
        chains.append(chain[:CHAIN])
    types = {w: i for i, w in enumerate(sorted({w for c in chains for w, _ in c}))}
    known = features(list(types), lexicon)
    places = max(map(len, chains))
    at, gold = np.zeros((len(chains), places), np.int64), np.zeros((len(chains), places), np.int64)
    live = np.zeros((len(chains), places), bool)
    for i, chain in enumerate(chains):
        at[i, : len(chain)], gold[i, : len(chain)] = [types[w] for w, _ in chain], [y for _, y in chain]
        live[i, : len(chain)] = True
    truth = np.eye(labels)[gold] * live[:, :, None]
    true_moves = np.zeros((labels, labels))
    both = live[:, 1:] & live[:, :-1]
    np.add.at(true_moves, (gold[:, :-1][both], gold[:, 1:][both]), 1)

    weights, moves, first = np.zeros((BUCKETS + 1, labels)), np.zeros((labels, labels)), np.zeros(labels)
    held = [weights, moves, first]
    means, squares = [np.zeros_like(h) for h in held], [np.zeros_like(h) for h in held]
    for epoch in range(1, EPOCHS + 1):
        scores = known.scores(weights)[at] * live[:, :, None]
        marginals, pairs, _ = forward_backward(scores, live, moves, first)
        error = (marginals - truth) * live[:, :, None]
        by_type = np.stack([np.bincount(at.ravel(), error[:, :, y].ravel(), len(types)) for y in range(labels)], 1)
        slopes = [
            known.slopes(by_type) + 0.02 * weights,
            pairs - true_moves + 0.1 * moves,
            error[:, 0].sum(axis=0) + 0.1 * first,
        ]
        for value, slope, mean, square in zip(held, slopes, means, squares):
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope**2 - square)
            value -= 0.15 * (mean / (1 - 0.9**epoch)) / (np.sqrt(square / (1 - 0.999**epoch)) + 1e-8)
    return Model(languages, lexicon, weights.astype(np.float32), moves, first)


class Tagger:
    """Applies a model to many texts; remembers the scores of words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)), np.float32)

    def _learn(self, words: set[str]) -> None:
        if len(self.places) > MAX_WORDS:
            self.places, self.scores = {}, self.scores[:0]
        new = [w for w in words if w not in self.places]
        for word in new:
            self.places[word] = len(self.places)
        self.scores = np.concatenate([self.scores, self.model.emissions(new)])

    def words(self, rows: list[list[str]]) -> np.ndarray:
        """Probabilities of each word of all rows, one row after the other."""
        self._learn({w for row in rows for w in row})
        sizes = np.array([len(r) for r in rows], np.int64)
        flat = np.fromiter((self.places[w] for row in rows for w in row), np.int64, int(sizes.sum()))
        inside = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        chains_of = -(-sizes // CHAIN)
        chain = np.repeat(np.cumsum(chains_of) - chains_of, sizes) + inside // CHAIN
        place = inside % CHAIN
        count = int(chains_of.sum())
        scores, live = np.zeros((count, CHAIN, len(self.model.languages))), np.zeros((count, CHAIN), bool)
        scores[chain, place], live[chain, place] = self.scores[flat], True
        marginals, _, _ = forward_backward(scores, live, self.model.moves, self.model.first)
        return marginals[chain, place]

    def documents(self, values: list[str]) -> list[tuple[str, float]]:
        """(language, its mean probability over the words) of each text; ``und`` and 0 without letters or languages."""
        with uncollected():
            rows = [words_of(v) for v in values]
            sizes = np.array([len(r) for r in rows], np.int64)
            if not self.model.languages or not sizes.sum():
                return [(UNKNOWN, 0.0)] * len(values)
            found = self.words(rows)
            filled = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[filled]
            means = np.add.reduceat(found, starts, axis=0) / sizes[filled][:, None]
            best = means.argmax(axis=1)
            result = [(UNKNOWN, 0.0)] * len(values)
            for i, y, p in zip(filled.tolist(), best.tolist(), means[np.arange(len(best)), best].tolist()):
                result[i] = (self.model.languages[y], min(1.0, max(0.0, p)))
            return result


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 on division by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample_segments(docs: DataFrame, per_language: int = SAMPLE_DOCS, seed: int = 7) -> list[tuple[str, list[str]]]:
    """The bounded training sample: segments of documents with a language, chosen by a hash of their id.

    Languages are counted over all rows. At most 2 * per_language + 100 documents of a
    language are expected, and of each at most three segments of 40 words, spread evenly over its whole text.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return []
    rates = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (str(lang), min(1.0, 1.5 * per_language / n))))
    number = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.select("lang", "text", number.alias("number")).where(F.col("number") < rates[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, numbers, parts = [], [], []
            for lang, number, text in zip(batch.column("lang").to_pylist(), batch.column("number").to_pylist(), texts(batch)):
                words = words_of(text)
                gap = max(SEGMENT_WORDS, len(words) // SEGMENTS)
                for at in range(0, min(len(words), gap * SEGMENTS), gap):
                    langs.append(lang)
                    numbers.append(number)
                    parts.append(words[at : at + SEGMENT_WORDS])
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(numbers, pa.float64()), pa.array(parts, pa.list_(pa.string()))],
                ["lang", "number", "words"],
            )

    rows = chosen.mapInArrow(run, "lang string, number double, words array<string>").collect()
    by_lang: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["number"], r["words"])):
        by_lang.setdefault(r["lang"], []).append((r["lang"], list(r["words"])))
    return [s for found in by_lang.values() for s in found[: per_language * SEGMENTS]]


def identify(docs: DataFrame, per_language: int = SAMPLE_DOCS, seed: int = 7) -> DataFrame:
    """``docs`` with held_out, lang_pred and score; learns from rows outside the held-out quarter.

    A prediction looks at the text alone. A null text, a text without letters, or a
    table without labelled rows gives ``und`` with score 0. A null doc_id is not held out
    and not learned from. Other columns are kept as they are (the three new names get
    underscores where they are taken); repeated rows get equal results. Whole texts count.
    """
    model = train(sample_segments(docs, per_language, seed), seed)
    key = zlib.crc32(model.weights.tobytes() + repr(model.languages).encode())
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 2^15 rows of weights
    names = docs.columns
    text_at = [n.lower() for n in names].index("text")
    new = [free_name(docs, n) for n in ("held_out", "lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = held(("tagger", key), lambda: Tagger(shared.value))
        for batch in batches:
            found = [f for group in grouped(texts(batch, text_at), GROUP) for f in tagger.documents(group)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [*names, *new],
            )

    rows = docs.withColumn(new[0], held_out(F.col("doc_id")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", {new[1]} string, {new[2]} double"
    return rows.mapInArrow(run, schema)
