"""Interpolated modified Kneser-Ney model (bigrams or trigrams), counted in Spark, scored from memory-mapped arrays.

Tokens are a text's words (runs outside ``\\x20 \\x09-\\x0D``, A-Z lower-cased)
and one end token; the first token's context is a start symbol.

    P(w | u)   = max(a(u w) - D(a(u w)), 0) / a(u .) + g(u) Pc(w)
    Pc(w)      = max(n(w) - D'(n(w)), 0) / T + g' / (V + 1)
    P(w | t u) = max(c(t u w) - D"(c(t u w)), 0) / c(t u .) + g(t u) P(w | u)

c counts training tokens, n(w) the distinct contexts of w, T the distinct
bigrams, V the distinct training tokens (one more stands for all unknown
words); D, D' and D" are the three modified discounts estimated from the counts
of counts at each level, and g the mass they free.  With ``order`` 2, a(u w) is
c(u w); with ``order`` 3 it is the number of distinct words before u w, except
behind the start symbol, where nothing can stand before.  A text's first token
has no word before its context and is scored by P(w | u); so is a token whose
context was never seen.  The whole sums to one over the V + 1 words.

1. Words of the training documents are counted: tasks pre-aggregate, ranges of
   the 64-bit word hash are merged and written as sorted arrays to the shared
   folder.  A word's id is its place in that order, so ids are spread evenly.
2. Tasks look ids up in the mapped vocabulary, pre-aggregate bigrams, and send
   them as packed sorted arrays to ranges of the context's id; each range is
   merged, written as a sorted array of 64-bit keys (context, word) with counts
   and its contexts' totals, and passes on, per word, the number of contexts
   it saw.  Ranges of words add those up.
3. For trigrams the key is (place of the bigram, word): the same range merge
   once more.  Each range passes on, per bigram of the last two words, the
   number of trigrams it saw, and ranges of bigrams add those up.
4. Workers map the arrays and score whole documents, chunk by chunk: lookups
   are sorted first, so they walk the arrays in order.

The driver sees one row of counts per range.  Ranges number one per
``RANGE_BYTES`` of training text, so a merging task's memory does not grow with
the corpus.  Counts are summed in 64 bits; an array is written in 32 if all of
it fits.  Word ids must fit 32 bits, and (bigrams) x (words) 64.

Edge cases: null and empty texts are one end token; a null id counts as the
empty string for the fold; repeated rows train and score one by one; words of
equal counts differ in nothing but their hash; very long texts are scored
whole, in a chunk of their own; without training documents every probability is
1; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .arrays import map_array, write_array
from .common import stored
from .textvec import chunks, mix64, words

FOLDS, HELD_OUT = 7, 2
#: Words of an n-gram unless the caller asks for another number (2 or 3).
ORDER = 2
RANGE_BYTES = 32 << 20
#: Entries a task gathers before it sends them on.
BUFFER = 3 << 20
END = np.uint64(0x656E642D746F6B65)
_BLOB = "part int, k binary, c binary"


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    if len(k) == 0:
        return k, c
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return k[first], np.add.reduceat(c, first)


def _gather(parts, bounds: np.ndarray):
    """Rows (part, keys, counts) from a stream of (keys, counts): merged in a bounded buffer, cut at ``bounds``."""
    keys, counts, n = [], [], 0

    def flush():
        k, c = _merged(keys, counts)
        at = np.concatenate(([0], np.searchsorted(k, bounds), [len(k)]))
        if len(c) and c.max() >= 1 << 32:
            raise OverflowError("a task's own counts must fit 32 bits: read smaller splits")
        rows = [(i, _key_blob(k[a:b]), _pack(c[a:b].astype(np.uint32)))
                for i, (a, b) in enumerate(zip(at, at[1:])) if b > a]
        if rows:
            i, k, c = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(k, pa.binary()), pa.array(c, pa.binary())],
                                             names=["part", "k", "c"])
    for k, c in parts:
        keys.append(k)
        counts.append(c)
        n += len(k)
        if n > BUFFER:
            k, c = _merged(keys, counts)
            keys, counts, n = [k], [c], len(k)
            if n > BUFFER // 2:
                yield from flush()
                keys, counts, n = [], [], 0
    if n:
        yield from flush()


def _key_blob(k: np.ndarray) -> bytes:
    """Sorted 64-bit keys as first differences of the high halves and the low halves, each packed."""
    high, low = (k >> np.uint64(32)).astype(np.uint32), k.astype(np.uint32)
    a = _pack(np.diff(high, prepend=np.uint32(0)))
    return len(a).to_bytes(4, "little") + a + _pack(low)


def _key_unblob(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:4], "little")
    high = np.cumsum(_unpack(b[4:4 + n], np.uint32), dtype=np.uint64)
    return (high << np.uint64(32)) | _unpack(b[4 + n:], np.uint32)


def _write_counts(folder: str, name: str, counts: np.ndarray) -> None:
    """In 32 bits if all fit, else in 64; a reader tells by the file's size."""
    narrow = not len(counts) or int(counts.max()) < 1 << 32
    write_array(folder, name, counts.astype("<u4" if narrow else "<u8"))


def _map_counts(folder: str, name: str, n: int) -> np.ndarray:
    raw = map_array(folder, name, np.uint8)
    return raw.view("<u8" if n and len(raw) == 8 * n else "<u4")


def _ends(arrays: list[np.ndarray]) -> np.ndarray:
    """Place of each array's first entry, laid end to end."""
    return np.concatenate(([0], np.cumsum([len(a) for a in arrays])[:-1]))


class Mapped:
    """The model's arrays, opened by a worker; ranges follow each other in key order."""

    def __init__(self, meta: dict):
        self.m = meta
        folder, ranges = meta["folder"], range(meta["parts"])
        keys = lambda name: [map_array(folder, f"{name}-{i}", "<u8") for i in ranges]
        counts = lambda name, like: [_map_counts(folder, f"{name}-{i}", len(a)) for i, a in enumerate(like)]
        self.words = keys("word")
        self.word_counts, self.first = counts("count", self.words), _ends(self.words)
        if meta.get("bigrams"):
            self.pairs = keys("pair")
            self.pair_counts, self.pair_first = counts("paircount", self.pairs), _ends(self.pairs)
        if meta.get("scored"):                    # bigram weights: counts, or with trigrams the adjusted ones
            high = meta["order"] == 3
            self.pair_weights = counts("adjusted", self.pairs) if high else self.pair_counts
            self.contexts = [_map_counts(folder, f"context-{i}", 4 * meta["width"]).reshape(-1, 4) for i in ranges]
            self.spread = [map_array(folder, f"spread-{i}", "<u4") for i in ranges]
            if high:
                self.triples = keys("triple")
                self.triple_counts, self.triple_first = counts("triplecount", self.triples), _ends(self.triples)

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Word ids of hashes, -1 for unknown words."""
        pos, hit = _search(h, self.words, self.m["hash_bounds"])
        return np.where(hit, pos, -1)

    def places(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Places of the bigrams (u, w) among all training bigrams, -1 where there is none."""
        out, both = np.full(len(u), -1), (u >= 0) & (w >= 0)
        pos, hit = _search(_key(u[both], w[both]), self.pairs, self.m["key_bounds"])
        out[both] = np.where(hit, pos, -1)
        return out

    @staticmethod
    def at(arrays: list[np.ndarray], first: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Values of arrays laid end to end, each beginning at ``first``, at ``ids``; 0 for negative ids."""
        out = np.zeros((len(ids), *arrays[0].shape[1:]), np.float64)
        part = np.where(ids >= 0, np.searchsorted(first, ids, side="right") - 1, -1)
        for p in np.flatnonzero(np.bincount(part + 1)[1:]) if len(ids) else ():
            own = part == p
            out[own] = arrays[p][ids[own] - first[p]]
        return out

    def log10(self, doc: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log10 P of every token, given the ids (-1: unknown) of texts that follow each other."""
        m = self.m
        u = _pairs(doc, ids, m["V"])
        place = self.places(u, ids)
        total, n1, n2, n3 = self.at(self.contexts, m["cuts"], u).T
        n = self.at(self.spread, m["cuts"], ids)
        t = max(m["T"], 1)
        free = sum(d * k for d, k in zip(m["Dc"], m["words"])) / t if m["T"] else 1.0
        below = (n - _discount(m["Dc"], n)) / t + free / (m["V"] + 1)
        p = _interpolate(self.at(self.pair_weights, self.pair_first, place), total, n1, n2, n3, m["D"], below)
        if m["order"] == 3:
            inner = np.concatenate(([False], doc[1:] == doc[:-1]))               # tokens with two before them
            context = np.where(inner, np.concatenate(([-1], place[:-1])), -1)     # the bigram that ends before the token
            p = self._longer(context, ids, p)
        return np.log10(p)

    def _longer(self, context: np.ndarray, ids: np.ndarray, below: np.ndarray) -> np.ndarray:
        """The trigram level over ``below``; contexts of -1 leave it as it is."""
        m, seen = self.m, np.flatnonzero(context >= 0)
        radix, bounds = np.uint64(m["V"] + 1), m["triple_bounds"]
        c = context[seen].astype(np.uint64)
        own, back = np.unique(c, return_inverse=True)
        lo, hi = (_before(k, self.triples, bounds) for k in (own * radix, (own + np.uint64(1)) * radix))
        kinds = np.zeros((3, len(own)))
        begin = 0
        while begin < len(own):                                                   # bounded expansion
            stop = begin + max(1, int(np.searchsorted(np.cumsum((hi - lo)[begin:]), 1 << 21, side="right")))
            size = (hi - lo)[begin:stop]
            at = np.arange(int(size.sum())) + np.repeat(lo[begin:stop] - (np.cumsum(size) - size), size)
            kind = np.minimum(self.at(self.triple_counts, self.triple_first, at), 3)
            which = np.repeat(np.arange(len(size)), size)
            for k in range(3):
                kinds[k, begin:stop] = np.bincount(which[kind == k + 1], minlength=len(size))
            begin = stop
        count, known = np.zeros(len(seen)), ids[seen] >= 0
        pos, hit = _search(c[known] * radix + ids[seen][known].astype(np.uint64), self.triples, bounds)
        count[known] = self.at(self.triple_counts, self.triple_first, np.where(hit, pos, -1))
        total = self.at(self.pair_counts, self.pair_first, context[seen])         # every seen context was followed by a token
        out = below.copy()
        out[seen] = _interpolate(count, total, *kinds[:, back], m["D3"], below[seen])
        return out


def _discount(d: list[float], counts: np.ndarray) -> np.ndarray:
    return np.asarray([0.0, *d])[np.minimum(counts, 3).astype(int)]


def _interpolate(count, total, n1, n2, n3, d: list[float], below) -> np.ndarray:
    """Discounted share of ``count`` in ``total`` plus the freed mass times ``below``; all of it below if total is 0."""
    safe = np.maximum(total, 1)
    mass = np.where(total > 0, (d[0] * n1 + d[1] * n2 + d[2] * n3) / safe, 1.0)
    return (count - _discount(d, count)) / safe + mass * below


def _before(keys: np.ndarray, arrays: list[np.ndarray], bounds: np.ndarray) -> np.ndarray:
    """Entries below each of the rising ``keys`` in the arrays laid end to end."""
    out, first = np.empty(len(keys), np.int64), _ends(arrays)
    at = np.concatenate(([0], np.searchsorted(keys, bounds), [len(keys)]))
    for a, base, lo, hi in zip(arrays, first, at, at[1:]):
        out[lo:hi] = base + np.searchsorted(a, keys[lo:hi])
    return out


def _search(keys: np.ndarray, arrays: list[np.ndarray], bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in the arrays laid end to end, and whether it is there; keys are looked up in order."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.concatenate(([True], k[1:] != k[:-1])) if len(k) else np.empty(0, bool)
    u = k[first]
    pos, hit = np.zeros(len(u), np.int64), np.zeros(len(u), bool)
    at = np.concatenate(([0], np.searchsorted(u, bounds), [len(u)]))
    base = 0
    for a, lo, hi in zip(arrays, at, at[1:]):
        if hi > lo and len(a):
            p = np.minimum(np.searchsorted(a, u[lo:hi]), len(a) - 1)
            pos[lo:hi] = p + base
            hit[lo:hi] = a[p] == u[lo:hi]
        base += len(a)
    back = np.cumsum(first) - 1
    out_pos, out_hit = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    out_pos[order], out_hit[order] = pos[back], hit[back]
    return out_pos, out_hit


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text index, token hash), texts in order, each ending with the end token."""
    w, rows = words(texts), len(texts)
    doc = np.concatenate([w.doc, np.arange(rows)])
    h = np.concatenate([w.hash, np.full(rows, mix64(np.array([END]))[0])])
    order = np.argsort(doc, kind="stable")                  # a text's words stand before its end
    return doc[order], h[order]


def _pairs(doc: np.ndarray, ids: np.ndarray, start: int) -> np.ndarray:
    """Context id of every token (start for a text's first)."""
    u = np.concatenate(([start], ids[:-1]))
    u[np.concatenate(([True], np.diff(doc) != 0))] = start
    return u


def _key(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (u.astype(np.uint64) << np.uint64(32)) | w.astype(np.uint64)


def _cuts(n: int, parts: int) -> np.ndarray:
    """First id of each range of ids 0 .. n - 1."""
    return np.arange(parts) * -(-n // parts)


def discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of entries counted 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (float(x) for x in n[:4])
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.0), i + 1.0) for i, d in enumerate(raw)]


def _tally(counts: np.ndarray) -> list[int]:
    """Entries counted 1, 2, 3, 4 times and more than twice, the sum, and the number of entries."""
    b = np.bincount(np.minimum(counts, 5), minlength=6) if len(counts) else np.zeros(6, int)
    return [int(x) for x in (*b[1:5], b[3:].sum(), counts.sum(), len(counts))]


def train(docs: DataFrame, order: int = ORDER) -> dict:
    """Count the model over ``docs`` (text), all of them; returns where its arrays are, and its constants."""
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = docs.sparkSession
    folder = scratch_path(spark, "lm")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(4, -(-size // RANGE_BYTES))
    step = (1 << 64) // parts
    hash_bounds = np.array([(i + 1) * step for i in range(parts - 1)], np.uint64)
    texts = docs.select("text")

    def count_words(batches):
        yield from _gather((_counted(_tokens(b.column(0))[1]) for b in chunks(batches)), hash_bounds)

    def merge_words(key, table):
        i = key[0].as_py()
        k, c = _merged([_key_unblob(x) for x in table.column("k").to_pylist()],
                       [_unpack(x, np.uint32) for x in table.column("c").to_pylist()])
        write_array(folder, f"word-{i}", k.astype("<u8"))
        _write_counts(folder, f"count-{i}", c)
        return pa.table({"part": pa.array([i], pa.int32()), "n": pa.array([len(k)], pa.int64()),
                         "tokens": pa.array([int(c.sum())], pa.int64())})
    got = {r.part: r for r in texts.mapInArrow(count_words, _BLOB).groupBy("part").applyInArrow(
        merge_words, "part int, n long, tokens long").collect()}             # one row per range
    for i in set(range(parts)) - set(got):
        write_array(folder, f"word-{i}", np.empty(0, "<u8"))
        write_array(folder, f"count-{i}", np.empty(0, "<u4"))
    meta = {"folder": folder, "parts": parts, "hash_bounds": hash_bounds, "order": order,
            "V": sum(r.n for r in got.values()), "N": sum(r.tokens for r in got.values())}
    v = meta["V"]
    if v >= 1 << 32:
        raise ValueError("word ids must fit 32 bits")
    cuts = _cuts(v + 1, parts)                                # ranges of ids; id v is the start symbol
    width = int(cuts[1])                                      # ids in a range
    meta |= {"cuts": cuts, "key_bounds": cuts[1:].astype(np.uint64) << np.uint64(32), "width": width}

    def count_pairs(batches):
        model = Mapped(meta)

        def each():
            for b in chunks(batches):
                doc, h = _tokens(b.column(0))
                ids = model.ids(h)
                yield _counted(_key(_pairs(doc, ids, v), ids))
        yield from _gather(each(), meta["key_bounds"])

    def write_context(i, k, c):
        """Sum and counts of counts of every context of a range."""
        u = (k >> np.uint64(32)).astype(np.int64) - int(cuts[i])
        total = np.zeros(width, np.int64)
        np.add.at(total, u, c)
        kinds = [np.bincount(u[m], minlength=width) for m in (c == 1, c == 2, c > 2)]
        _write_counts(folder, f"context-{i}", np.stack([total, *kinds], axis=1).ravel())

    def merge_pairs(key, table):
        i = key[0].as_py()
        k, c = _merged([_key_unblob(x) for x in table.column("k").to_pylist()],
                       [_unpack(x, np.uint32) for x in table.column("c").to_pylist()])
        write_array(folder, f"pair-{i}", k.astype("<u8"))
        _write_counts(folder, f"paircount-{i}", c)
        if order == 2:
            write_context(i, k, c)
        w, n = _counted((k & np.uint64(0xFFFFFFFF)))           # distinct contexts seen per word
        at = np.concatenate(([0], np.searchsorted(w, cuts[1:].astype(np.uint64)), [len(w)]))
        rows = [(p, _key_blob(w[a:b]), _pack(n[a:b].astype(np.uint32))) for p, (a, b) in enumerate(zip(at, at[1:]))]
        p, kk, cc = zip(*rows)
        return pa.table({"src": pa.array([i] * len(rows), pa.int32()), "part": pa.array(p, pa.int32()),
                         "k": pa.array(kk, pa.binary()), "c": pa.array(cc, pa.binary()),
                         "tally": pa.array([_tally(c) if j == 0 else None for j in range(len(rows))], pa.list_(pa.int64()))})
    seen = stored(texts.mapInArrow(count_pairs, _BLOB).groupBy("part").applyInArrow(
        merge_pairs, "src int, " + _BLOB + ", tally array<bigint>"), "lm-contexts")
    ranges = {r.src: r.tally for r in seen.where("tally IS NOT NULL").select("src", "tally").collect()}
    pair_tally = np.sum([*ranges.values(), [0] * 7], axis=0)

    def merge_spread(key, table):
        i = key[0].as_py()
        out = np.zeros(width, np.int64)
        for k, c in zip(table.column("k").to_pylist(), table.column("c").to_pylist()):
            out[_key_unblob(k).astype(np.int64) - int(cuts[i])] += _unpack(c, np.uint32)
        write_array(folder, f"spread-{i}", out.astype("<u4"))
        return pa.table({"part": pa.array([i], pa.int32()), "tally": pa.array([_tally(out[out > 0])], pa.list_(pa.int64()))})
    spread = seen.select("part", "k", "c").groupBy("part").applyInArrow(merge_spread, "part int, tally array<bigint>").collect()
    written = {r.part: r.tally for r in spread}
    for i in set(range(parts)) - set(ranges):                 # ranges without a bigram
        for name, n in (("pair", 0), ("paircount", 0), ("adjusted", 0), ("context", 4 * width)):
            write_array(folder, f"{name}-{i}", np.zeros(n, "<u8" if name == "pair" else "<u4"))
    for i in set(range(parts)) - set(written):
        write_array(folder, f"spread-{i}", np.zeros(width, "<u4"))
    word_tally = np.sum([*written.values(), [0] * 7], axis=0)
    meta |= {"bigrams": True, "D": discounts(pair_tally), "Dc": discounts(word_tally), "T": int(pair_tally[6]),
             "words": [int(word_tally[0]), int(word_tally[1]), int(word_tally[4])]}
    if order == 3:
        _train_triples(texts, meta, set(ranges), write_context)
    return meta | {"scored": True}


def _train_triples(texts: DataFrame, meta: dict, ranges: set, write_context) -> None:
    """Trigrams and adjusted bigram counts; fills in ``meta``.  ``ranges``: ranges that hold bigrams."""
    folder, parts, v = meta["folder"], meta["parts"], meta["V"]
    radix = v + 1
    if (meta["T"] + 1) * radix >= 1 << 64:
        raise ValueError("bigrams times words must fit 64 bits")
    meta["triple_bounds"] = _cuts(max(meta["T"], 1), parts)[1:].astype(np.uint64) * np.uint64(radix)

    def count_triples(batches):
        model = Mapped(meta)

        def each():
            for b in chunks(batches):
                doc, h = _tokens(b.column(0))
                ids = model.ids(h)
                place = model.places(_pairs(doc, ids, v), ids)[:-1]
                inner = doc[1:] == doc[:-1]
                yield _counted(place[inner].astype(np.uint64) * np.uint64(radix) + ids[1:][inner].astype(np.uint64))
        yield from _gather(each(), meta["triple_bounds"])

    def merge_triples(key, table):
        i = key[0].as_py()
        k, c = _merged([_key_unblob(x) for x in table.column("k").to_pylist()],
                       [_unpack(x, np.uint32) for x in table.column("c").to_pylist()])
        write_array(folder, f"triple-{i}", k.astype("<u8"))
        _write_counts(folder, f"triplecount-{i}", c)
        # the last two words of every trigram: what follows the second word of its bigram
        model = Mapped(meta)
        place, w = k // np.uint64(radix), k % np.uint64(radix)
        own, back = np.unique(place, return_inverse=True)
        second = np.empty(len(own), np.uint64)
        part = np.searchsorted(model.pair_first, own, side="right") - 1
        for p in np.unique(part):
            mine = part == p
            second[mine] = model.pairs[p][own[mine] - np.uint64(model.pair_first[p])] & np.uint64(0xFFFFFFFF)
        two, n = _counted((second[back] << np.uint64(32)) | w)
        at = np.concatenate(([0], np.searchsorted(two, meta["key_bounds"]), [len(two)]))
        rows = [(p, _key_blob(two[a:b]), _pack(n[a:b].astype(np.uint32))) for p, (a, b) in enumerate(zip(at, at[1:]))]
        p, kk, cc = zip(*rows)
        return pa.table({"src": pa.array([i] * len(rows), pa.int32()), "part": pa.array(p, pa.int32()),
                         "k": pa.array(kk, pa.binary()), "c": pa.array(cc, pa.binary()),
                         "tally": pa.array([_tally(c) if j == 0 else None for j in range(len(rows))], pa.list_(pa.int64()))})
    seen = stored(texts.mapInArrow(count_triples, _BLOB).groupBy("part").applyInArrow(
        merge_triples, "src int, " + _BLOB + ", tally array<bigint>"), "lm-triples")
    got = {r.src: r.tally for r in seen.where("tally IS NOT NULL").select("src", "tally").collect()}
    for i in set(range(parts)) - set(got):
        write_array(folder, f"triple-{i}", np.empty(0, "<u8"))
        write_array(folder, f"triplecount-{i}", np.empty(0, "<u4"))

    def adjust(key, table):
        i = key[0].as_py()
        k = map_array(folder, f"pair-{i}", "<u8")
        out = np.zeros(len(k), np.int64)
        for kk, c in zip(table.column("k").to_pylist(), table.column("c").to_pylist()):
            if kk is not None:
                out[np.searchsorted(k, _key_unblob(kk))] += _unpack(c, np.uint32)
        start = (k >> np.uint64(32)) == np.uint64(v)           # nothing stands before the start: plain counts
        out[start] = _map_counts(folder, f"paircount-{i}", len(k))[start]
        _write_counts(folder, f"adjusted-{i}", out)
        write_context(i, k, out)
        return pa.table({"part": pa.array([i], pa.int32()), "tally": pa.array([_tally(out)], pa.list_(pa.int64()))})
    # every range that holds bigrams is written, also one whose bigrams all stand at the start
    every = texts.sparkSession.createDataFrame([(i, None, None) for i in sorted(ranges)], _BLOB)
    tallies = (seen.select("part", "k", "c").unionByName(every).groupBy("part")
               .applyInArrow(adjust, "part int, tally array<bigint>").collect()) if ranges else []
    meta |= {"D": discounts(np.sum([[0] * 7, *(r.tally for r in tallies if r.part in ranges)], axis=0)),
             "D3": discounts(np.sum([[0] * 7, *got.values()], axis=0))}


def fold(id_col: str):
    """The held-out remainder test on a document's id."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def score(docs: DataFrame, meta: dict) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of docs (doc_id, held_out, text)."""
    def run(batches):
        model = Mapped(meta)
        for b in chunks(batches):
            doc, h = _tokens(b.column("text"))
            rows = b.num_rows
            ids = model.ids(h)
            c = model.at(model.word_counts, model.first, ids)
            add = lambda x: np.bincount(doc, x, minlength=rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(np.bincount(doc, minlength=rows), pa.int64()),
                 pa.array(add(c > 0).astype(np.int64)), pa.array(np.full(rows, meta["N"], np.int64)),
                 pa.array(add(np.log10((c + 1) / (meta["N"] + meta["V"] + 1)))), pa.array(add(model.log10(doc, ids)))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return docs.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                "base_score double, score double")


def perplexity(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Train on the documents outside the held-out fold, score all."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), fold(id_col).alias("held_out"),
                       F.col(text_col).alias("text"))
    return score(rows, train(rows.where("NOT held_out"), order))
