"""Token ids of a word-level BPE (white space dropped, lower case, word ends marked), many texts at once.

White space never survives this family of tokenizers and no rule looks across
it, so a text's ids are the ids of its words, one after the other.  Words are
encoded once per chunk and their ids gathered by numpy.

Words of printable ASCII and plain Latin letters are lower-cased and split here
(their normal form is themselves, so nothing else can happen to them), and the
pieces go to the library's BPE model, remembered in a bounded table.  Any other
word, or one that holds a special token, goes whole through the tokenizer.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .textvec import flat, word_array, word_spans

#: Pieces of up to 40 letters remembered by a worker; the table starts anew when it is full.
REMEMBERED = 400_000
REMEMBERED_LETTERS = 40
# The tokenizer's split pattern on lower-cased letters and numbers below U+0180.
LETTERS = "a-zªµºß-öø-ÿĀ-ſ"
NUMBERS = "0-9²³¹¼½¾"
SPLIT = re.compile(f"\n|'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}\n]+")
#: Printable ASCII and U+00A1 to U+017F without the dotted capital I, whose lower case is two characters.
PLAIN = "^[!-~¡-įı-ſ]+$"


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for every byte: itself if printable in Latin-1, else the next one from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, list[int]] = {}

    def _learn(self, pieces: list[str]) -> None:
        """Encode the pieces that are not known yet."""
        new = set(pieces) - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set(pieces)
        for p in new:
            shown = p if p.isascii() else p.encode().decode("latin-1").translate(self.letters)
            self.known[p] = [t.id for t in self.model.tokenize(shown)]
        self.known["\n"] = []                       # the border between two words

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of ids of each word)."""
        pieces = SPLIT.findall("\n".join(words).lower())
        self._learn(pieces)
        coded = [self.known[p] for p in pieces]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        behind = np.append(np.cumsum(size)[size == 0], size.sum())
        ids = np.fromiter(chain.from_iterable(coded), np.uint32, int(behind[-1]))
        for p in {p for p in pieces if len(p) > REMEMBERED_LETTERS}:
            self.known.pop(p, None)
        return ids, np.diff(behind, prepend=0)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of ids of each word) of distinct words."""
        plain = pc.match_substring_regex(words, PLAIN)
        for s in self.special:
            plain = pc.and_not(plain, pc.match_substring(words, s))
        size, parts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        mask = plain.to_numpy(zero_copy_only=False)
        ids = [np.empty(0, np.uint32)]
        if mask.any():
            one, n = self._plain(words.filter(plain).to_pylist())
            ids.append(one)
            size[mask], parts[mask] = n, np.cumsum(n) - n
        held = sum(map(len, ids))
        for k in np.flatnonzero(~mask):
            one = self.tokenizer.encode(words[int(k)].as_py(), add_special_tokens=False).ids
            ids.append(np.array(one, np.uint32))
            size[k], parts[k] = len(one), held
            held += len(one)
        order = np.concatenate(ids)
        return order[_ranges(parts, size)], size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        data, offsets = flat(texts)
        start, end, doc = word_spans(data, offsets)
        if len(start) == 0:
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        coded = word_array(data, start, end).dictionary_encode()
        ids, size = self.words(coded.dictionary.cast(pa.large_string()))
        which = coded.indices.to_numpy()
        n = size[which]
        total = np.concatenate(([0], np.cumsum(n)))
        edges = total[np.searchsorted(doc, np.arange(len(texts) + 1))]
        return ids[_ranges((np.cumsum(size) - size)[which], n)], np.diff(edges)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    behind = np.cumsum(size)
    return np.arange(int(behind[-1]) if len(behind) else 0) + np.repeat(start - (behind - size), size)


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
    return WordEncoder(path)
