"""Words of many texts at once, as numpy arrays over one Arrow buffer.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D``; ASCII capitals are
lower-cased first where asked for.  Work goes in chunks of a few megabytes of
text, so a task's memory follows ``CHUNK_BYTES`` and its longest single text,
not its batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """1, s, s^2, ... modulo 2^64 for a fixed odd s."""
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 256), _STEP, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS[:n]


class Words(NamedTuple):
    data: np.ndarray    # bytes of all texts, lower-cased where asked for
    offsets: np.ndarray  # text i is data[offsets[i]:offsets[i + 1]]
    start: np.ndarray   # first byte of each word
    end: np.ndarray     # byte behind each word
    doc: np.ndarray     # index of the text that holds it
    hash: np.ndarray    # 64-bit hash of its bytes


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(offsets) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def hash_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of data[start:end] per run (runs are not empty)."""
    size = end - start
    if len(size) == 0:
        return np.empty(0, np.uint64)
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    pos = np.arange(int(size.sum())) - np.repeat(first, size)
    vals = _BYTE[data[pos + np.repeat(start, size)]]
    vals *= powers(int(size.max()))[pos]
    return mix64(np.add.reduceat(vals, first) + size.astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte behind, text) of every word of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    n = len(data)
    if n == 0:
        z = np.empty(0, np.int64)
        return z, z, z
    ink = ~SPACE[data]
    cut = np.zeros(n + 1, bool)      # a text begins here
    cut[offsets] = True
    before = np.concatenate(([False], ink[:-1])) & ~cut[:n]
    after = np.concatenate((ink[1:], [False])) & ~cut[1:]
    start = np.flatnonzero(ink & ~before)
    end = np.flatnonzero(ink & ~after) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_array(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.LargeBinaryArray:
    """The words ``data[start:end]`` as one Arrow array."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] += 1
    inside[end] -= 1
    ink = np.ascontiguousarray(data[np.cumsum(inside[:-1], dtype=np.int8) > 0])
    offsets = np.concatenate(([0], np.cumsum(end - start)))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(ink)])


def words(texts: pa.Array, lower: bool = True) -> Words:
    data, offsets = flat(texts)
    if lower:
        data = LOWER[data]
    start, end, doc = word_spans(data, offsets)
    return Words(data, offsets, start, end, doc, hash_runs(data, start, end))


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` again, in slices of about ``max_bytes`` of text (at least one row each)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size.astype(np.int64)) // max_bytes
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def segments(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index of each run of equal values in sorted ``doc``, and the values."""
    if len(doc) == 0:
        return np.empty(0, np.int64), doc
    first = np.concatenate(([0], np.flatnonzero(np.diff(doc)) + 1))
    return first, doc[first]
