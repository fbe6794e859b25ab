"""Exact encoding with the word-level tokenizer file, one library call per new word only.

The tokenizer file's rules cut a text into pieces and never join ids across them, so the
ids of a text are those of its pieces put one after the other. Texts of Latin-1 characters are
cut as a whole; the others word by word, because only the library's normalizer knows their
rules. Pieces and words are remembered in the worker between batches and tasks, up to a fixed number.
"""

from __future__ import annotations

import re
import unicodedata
from array import array

import numpy as np
import regex
from tokenizers import Tokenizer

from corpusloom.llm.bpe_trie import byte_letters
from corpusloom.llm.common import Memory, held, uncollected

# Characters that str.split takes for white space and the tokenizer does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
# Fixed value: the piece pattern of the word-level tokenizer.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

# The same for lower-cased Latin-1, where letters, numbers and white space can be listed.
_LETTERS, _NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
LATIN_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")
BEYOND_LATIN = re.compile("[^\x00-\xff]")

MAX_WORDS, MAX_PIECES = 50_000, 250_000


class WordEncoder:
    """Ids of texts as little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if self.vocabulary <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = {b: c for c, b in byte_letters().items()}
        self.words, self.pieces = Memory(MAX_WORDS), Memory(MAX_PIECES)

    def _learn_pieces(self, pieces: set[str]) -> None:
        """Ids of pieces not met before, from the library's model."""
        tokenize, code = self.tokenizer.model.tokenize, "H" if self.width == 2 else "I"
        for piece in self.pieces.missing(pieces):
            plain = piece.isascii() and piece.isprintable()
            letters = piece if plain else "".join([self.letters[b] for b in piece.encode("utf-8", "replace")])
            self.pieces[piece] = array(code, [t.id for t in tokenize(letters)]).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Ids of new words from the ids of their pieces."""
        cut = {w: self._pieces(w) for w in words}
        self._learn_pieces(set().union(*cut.values()))
        for word, pieces in cut.items():
            self.words[word] = b"".join([self.pieces[p] for p in pieces])

    def _pieces(self, word: str) -> list[str]:
        """The pieces of a word by the file's rules; a word of letters alone is one piece."""
        if word.isascii():
            return [word.lower()] if word.isalpha() else PIECES.findall(word.lower())
        if word.isalpha() and "Σ" not in word and unicodedata.is_normalized("NFC", word):
            return PIECES.findall(word.lower())
        return PIECES.findall(self.tokenizer.normalizer.normalize_str(word))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts. Special tokens' strings and odd separators take the library's own path."""
        with uncollected():
            return self._encode_all(texts)

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        ids: list[bytes] = [b""] * len(texts)
        latin: dict[int, list[str]] = {}
        other: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            if SEPARATORS.search(text) or any(a in text for a in self.added):
                ids[i] = self._whole(text)
            elif text.isascii() or not BEYOND_LATIN.search(text):
                # All characters are in normal form, and lower-casing one never looks at its neighbours.
                latin[i] = LATIN_PIECES.findall(text.lower())
            else:
                other[i] = text.split()
        self._learn_pieces(set().union(*latin.values()))
        for i, row in latin.items():
            ids[i] = b"".join(map(self.pieces.__getitem__, row))
        self._learn(self.words.missing(set().union(*other.values())))
        for i, row in other.items():
            ids[i] = b"".join(map(self.words.__getitem__, row))
        self.words.turn()
        self.pieces.turn()
        return ids


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    return held(("words", path), lambda: WordEncoder(path))
