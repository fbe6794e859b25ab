"""Byte-level BPE by prefix-sharing trie traversal, and decoding.

Each node of the trie of distinct words stands for a prefix of some word and holds the
last token of that prefix's encoding. The last token of a longer prefix is the one
vocabulary entry that ends it and that the merge rules leave standing beside the
encoding of what is before it. So words with a common prefix share its work, and a
word's ids are read back from its end node. The sorted words are the trie in depth-first
order, so only the path to the current node is held.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from corpusloom.llm.common import Memory, grouped, held, texts, uncollected

# Fixed value: the word pattern of the byte-level tokenizer.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Fixed value: characters that str.split takes for white space and the pattern does not.
SEPARATORS = re.compile("[\x1c-\x1f]")

MAX_WORDS = 200_000
MAX_PAIRS = 500_000
# So many characters of text are encoded together: their new words make one trie.
GROUP = 2_000_000

SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

LITTLE = sys.byteorder == "little" and array("I").itemsize == 4

def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the tokenizer file, by its rule."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TrieEncoder:
    """Encodes and decodes with the vocabulary and merges of one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        letters, model = byte_letters(), whole["model"]
        spelled = {t: bytes(letters[c] for c in t) for t in model["vocab"]}
        self.ids = {spelled[t]: i for t, i in model["vocab"].items()}
        size = max(model["vocab"].values(), default=-1) + 1
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        size = max(size, *(i + 1 for i in self.special.values())) if self.special else size
        self.bytes_of = [b""] * size
        for word, i in self.ids.items():
            self.bytes_of[i] = word
        for word, i in self.special.items():
            self.bytes_of[i] = word.encode()
        self.length = [len(b) for b in self.bytes_of]
        self.rank, self.parts, self.merged = [-1] * size, [(-1, -1)] * size, {}
        for rank, (a, b) in enumerate(model["merges"]):
            left, right, both = self.ids[spelled[a]], self.ids[spelled[b]], self.ids[spelled[a] + spelled[b]]
            if self.rank[both] >= 0:
                raise ValueError(f"two merges make token {both}; its last merge is not unique")
            self.rank[both], self.parts[both], self.merged[left << 32 | right] = rank, (left, right), both
        self.starts = {word[:n] for word in self.ids for n in range(1, len(word) + 1)}
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pairs: dict[int, bool] = {}
        self.words, self.pieces = Memory(MAX_WORDS), Memory(MAX_WORDS)

    def stands(self, left: int, right: int) -> bool:
        """Whether the merge rules keep the border between two neighbouring tokens.

        Takes the two tokens apart again, last merge first. If at some point the two
        pieces at the border have a merge that came earlier, the border was not kept.
        Among equal merges the one further left comes first.
        """
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is not None:
            return known
        rank, parts, merged, before, kept = self.rank, self.parts, self.merged, len(self.rank), True
        while True:
            both = merged.get(left << 32 | right)
            if both is not None and rank[both] < before:
                kept = False
                break
            if rank[left] > rank[right]:
                before, left = rank[left], parts[left][1]
            elif rank[right] >= 0:
                before, right = rank[right] + 1, parts[right][0]
            else:
                break
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        self.pairs[key] = kept
        return kept

    def traverse(self, words: list[bytes]) -> list[bytes]:
        """Ids of sorted distinct words, by one depth-first walk of their trie.

        In sorted order each word goes on from the deepest node it shares with the one
        before, so the path to that node is all that is kept. ``last[d]`` is the last
        token at depth d of the path; ``open_[d]`` is where the longest suffix begins
        that some vocabulary entry starts with: no candidate begins before it.
        """
        ids, starts, stands, pairs = self.ids, self.starts, self.stands, self.pairs
        last, open_, path, found = [-1], [0], b"", []
        for word in words:
            depth, both = 0, min(len(word), len(path))
            while depth < both and word[depth] == path[depth]:
                depth += 1
            del last[depth + 1 :], open_[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                start = open_[-1]
                while word[start:end] not in starts:
                    start += 1
                open_.append(start)
                while True:
                    token = ids.get(word[start:end])
                    if token is not None:
                        if not start:
                            break
                        kept = pairs.get(last[start] << 32 | token)
                        if kept or kept is None and stands(last[start], token):
                            break
                    start += 1
                last.append(token)
            path = word
            found.append(self._ids(last))
        return found

    def _ids(self, last: list[int]) -> bytes:
        back, end = [], len(last) - 1
        while end:
            back.append(last[end])
            end -= self.length[last[end]]
        return array("I", back[::-1]).tobytes() if LITTLE else np.array(back[::-1], "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Ids of new words: cut by the pattern; the trie of all new pieces is walked once."""
        cut = {w: WORDS.findall(w) for w in words}
        spelled = {p.encode("utf-8", "replace"): p for p in self.pieces.missing({p for ps in cut.values() for p in ps})}
        order = sorted(spelled)
        for piece, ids in zip(order, self.traverse(order)):
            self.pieces[spelled[piece]] = ids
        for word, pieces in cut.items():
            self.words[word] = b"".join([self.pieces[p] for p in pieces])

    @staticmethod
    def _chunks(text: str) -> list[str]:
        """A text without special tokens, cut where the pattern always cuts.

        Where single spaces and line ends are the only white space, the text falls into
        " word" chunks that the pattern cuts independently; else the pattern cuts it whole.
        """
        if not text:
            return []
        parts = text.split(" ")
        if len(text.split()) == len(parts) + text.count("\n") and not SEPARATORS.search(text):
            return [parts[0], *[" " + p for p in parts[1:]]]
        return WORDS.findall(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        with uncollected():
            return self._encode_all(texts)

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        rows = []
        for text in texts:
            if self.splitter is not None and any(t in text for t in self.special):
                pieces = self.splitter.split(text)
                rows.append([c for i, p in enumerate(pieces) for c in ([(p,)] if i % 2 else self._chunks(p))])
            else:
                rows.append(self._chunks(text))
        self._learn(self.words.missing({c for row in rows for c in row if type(c) is str}))
        for name, token in self.special.items():
            self.words[(name,)] = np.array([token], "<u4").tobytes()
        ids = [b"".join(map(self.words.__getitem__, row)) for row in rows]
        self.words.turn()
        self.pieces.turn()
        return ids

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character."""
        return b"".join([self.bytes_of[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def trie_encoder(path: str) -> TrieEncoder:
    """The worker's encoder for a tokenizer file."""
    return held(("trie", path), lambda: TrieEncoder(path))


def encode_documents(docs: DataFrame, tokenizer: str, digests: bool = False) -> DataFrame:
    """Ids and decoded text of every document; no shuffle, one pass.

    ``docs`` needs doc_id and text; other columns are left aside. Returns doc_id,
    n_tokens, ids (little-endian unsigned 32-bit) and decoded. With ``digests`` both
    are SHA-256 hex digests instead, so that whole texts do not leave the worker.

    A null text is empty: no ids, empty text. A null doc_id stays null; repeated rows
    give repeated results. Long texts need memory in proportion to their own length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = trie_encoder(tokenizer)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for found in (ids for group in grouped(texts(batch), GROUP) for ids in encoder.encode_all(group)):
                back = encoder.decode(found)
                counts.append(len(found) // 4)
                ids.append(hashlib.sha256(found).hexdigest() if digests else found)
                decoded.append(hashlib.sha256(back.encode("utf-8", "replace")).hexdigest() if digests else back)
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "n_tokens", "ids", "decoded"]
            kinds = [pa.string() if digests else pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), *(pa.array(v, k) for v, k in zip((ids, decoded), kinds))],
                names,
            )

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return rows.mapInArrow(run, DIGESTS if digests else SCHEMA)
