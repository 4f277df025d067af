"""Maximal repetitions (runs) of words, found from Lyndon arrays by Baier grouping.

A run is a stretch of consecutive words with smallest period q, at least two
periods long, that can't be extended keeping q.  By the runs theorem every run
has, under an order of the alphabet or under the reverse order, a Lyndon root
that is the longest Lyndon word at its start.  So the Lyndon arrays under both
orders name every candidate (start, period), and extending a candidate by its
longest common extensions to both sides gives the run.

``lyndon_lengths`` is the first phase of Baier's suffix sorter.  Suffixes are
kept in groups by the Lyndon prefix known so far, groups in lexicographic
order.  The highest unfinished group is final: its word is the longest Lyndon
word at each of its places.  Each of its places then lengthens the word of the
place before it (the nearest one of a lower group), and the places so
lengthened move to new groups directly above their old one, ordered by how many
words they took up.  No suffix is compared and no suffix array is built.  Any
order of the alphabet serves, so words are numbered as they come.

A run of at least ``min_words`` words has at least half = ceil(min_words / 2)
places where the words q apart agree, so every place of it lies in a stretch of
``half`` words that occurs twice in the document.  Documents are first cut to
the stretches covered by such repeats (found by hashes, which may cover too
much, never too little); a run lies whole in one stretch, and texts that repeat
nothing cost a sort.

Memory follows the chunk (2 MB of text) or the longest document.  Nothing is
shuffled.

Edge cases: null, empty and white texts have no words and no runs; words are
compared as bytes, without lower-casing; equal lengths are all kept (runs are
ordered by start, then period); repeated rows give repeated results; null ids
pass through; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textvec import chunks, flat, mix64, powers, word_array, word_spans

MIN_WORDS = 12
SCHEMA = ("doc_id long, n_words long, n_kept long, runs array<struct<start: long, length: long, period: long>>, "
          "collapsed string")


def lyndon_lengths(s: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place of ``s`` (letters 0, 1, ... all in use)."""
    n = len(s)
    left, right = list(range(-1, n + 1)), list(range(1, n + 3))     # neighbours in place 1..n; 0 and n + 1 are ends
    order = np.argsort(s, kind="stable")
    letters = int(s.max()) + 1
    edges = np.searchsorted(s[order], np.arange(letters + 1)).tolist()
    places = (order + 1).tolist()
    members = [places[a:b] for a, b in zip(edges, edges[1:])]
    size = [len(m) for m in members]
    group = [-1, *s.tolist(), -1]
    below, above = list(range(-1, letters - 1)), list(range(1, letters + 1))
    length = [0] * (n + 2)

    def raise_above(h: int, moved: list[int]) -> int:
        """``moved`` places leave group h for a new group directly above it."""
        g, up = len(members), above[h]
        members.append(moved)
        size.append(len(moved))
        below.append(h)
        above.append(up)
        above[h] = below[up] = g
        for y in moved:
            group[y] = g
        return g

    g = letters - 1
    below.append(g)                  # a head above the highest letter, so that every group has one above
    members.append([])
    size.append(0)
    above.append(-1)
    while g >= 0:
        here = members[g]
        if size[g] < len(here):      # some moved up since
            here = [i for i in here if group[i] == g]
        if len(here) == 1:
            i = here[0]
            p, q = left[i], right[i]
            length[i] = q - i
            right[p], left[q] = q, p
            h = group[p]
            if p and size[h] > 1:
                size[h] -= 1
                raise_above(h, [p])
        elif here:
            word = right[here[-1]] - here[-1]
            taken: dict[int, int] = {}
            for i in reversed(here):
                p, q = left[i], right[i]
                length[i] = word
                right[p], left[q] = q, p
                taken[p] = taken.get(p, 0) + taken.pop(i, 0) + 1
            taken.pop(0, None)
            buckets: dict[int, dict[int, list[int]]] = {}
            for y in reversed(taken):               # rising places
                buckets.setdefault(group[y], {}).setdefault(taken[y], []).append(y)
            for h, by_count in buckets.items():
                if len(by_count) == 1 and len(next(iter(by_count.values()))) == size[h]:
                    continue                        # the whole group took up the same: it stays as it is
                at = h
                for k in sorted(by_count):
                    size[h] -= len(by_count[k])
                    at = raise_above(at, sorted(by_count[k]))
        g = below[g]
    return np.array(length[1:n + 1], np.int64)


def _extent(w: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """Largest [a, b) around or next to i with w[k] == w[k + q] for all k in it."""
    n, b, step = len(w) - q, i, 64
    while b < n:
        c = min(b + step, n)
        bad = np.flatnonzero(w[b:c] != w[b + q:c + q])
        if len(bad):
            b += int(bad[0])
            break
        b, step = c, step * 2
    a, step = i, 64
    while a > 0:
        c = max(a - step, 0)
        bad = np.flatnonzero(w[c:a] != w[c + q:a + q])
        if len(bad):
            a = c + int(bad[-1]) + 1
            break
        a, step = c, step * 2
    return a, b


def runs_of(w: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``min_words`` in ``w``, by start, then period."""
    n = len(w)
    if n < 2:
        return []
    s = np.unique(w, return_inverse=True)[1]
    where, period = [], []
    for letters in (s, s.max() - s):
        lam = lyndon_lengths(letters)
        i = np.flatnonzero(2 * lam <= n)
        where.append(i)
        period.append(lam[i])
    i, q = np.concatenate(where), np.concatenate(period)
    # a run agrees with itself one period on in at least max(min_words - q, q) places around its root
    need = min((min_words + 1) // 2, 64)
    agree = np.zeros(len(i), np.int64)
    for step in (1, -1):
        k = i if step == 1 else i - 1
        on = np.ones(len(i), bool)
        for _ in range(need):
            on &= (k >= 0) & (k + q < n)
            on[on] = s[k[on]] == s[k[on] + q[on]]
            agree += on
            k = k + step
    i, q = i[agree >= need], q[agree >= need]
    order = np.lexsort((i, q))
    out, last, reach = [], 0, -1
    for at, p in zip(i[order].tolist(), q[order].tolist()):
        if p == last and at <= reach:
            continue                 # another root of the same stretch
        a, b = _extent(s, at, p)
        last, reach = p, b
        if b - a >= p and b - a + p >= min_words:
            out.append((a, b - a + p, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def covered(ids: np.ndarray, doc: np.ndarray, half: int) -> np.ndarray:
    """Words inside a stretch of ``half`` words whose hash occurs twice in their document."""
    n = len(ids)
    out = np.zeros(n + 1, np.int64)
    if n <= half:
        return out[:n] > 0
    weight = powers(half)
    m = n - half + 1
    gram = np.zeros(m, np.uint64)
    h = mix64(ids.astype(np.uint64) + np.uint64(1))
    for k in range(half):
        gram += h[k:k + m] * weight[k]
    whole = np.flatnonzero(doc[:m] == doc[half - 1:])        # stretches inside one document
    key = mix64(gram[whole]) ^ mix64(doc[whole].astype(np.uint64) << np.uint64(32))
    order = np.argsort(key)
    same = np.flatnonzero(key[order][1:] == key[order][:-1])
    twice = np.unique(whole[np.concatenate((order[same], order[same + 1]))])
    np.add.at(out, twice, 1)
    np.subtract.at(out, twice + half, 1)
    return np.cumsum(out[:n]) > 0


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_words, n_kept, runs, collapsed).

    ``collapsed`` is the text with one space between words and without the
    words that a run holds behind its first period.
    """
    if min_words < 2:
        raise ValueError("min_words must be 2 or more")
    half = (min_words + 1) // 2
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def run(batches):
        for b in chunks(batches):
            data, offsets = flat(b.column("text"))
            start, end, doc = word_spans(data, offsets)
            ids = word_array(data, start, end).dictionary_encode().indices.to_numpy().astype(np.int64)
            found, kept = _runs(ids, doc, b.num_rows, half, min_words)
            text = _collapsed(data, offsets, start, end, doc, kept)
            flat_runs = np.array([r for d in found for r in d], np.int64).reshape(-1, 3)
            ends = np.concatenate(([0], np.cumsum([len(d) for d in found])))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.bincount(doc, minlength=b.num_rows), pa.int64()),
                 pa.array(np.bincount(doc[kept], minlength=b.num_rows), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                     [pa.array(c, pa.int64()) for c in flat_runs.T], names=["start", "length", "period"])), text],
                names=["doc_id", "n_words", "n_kept", "runs", "collapsed"])
    return rows.mapInArrow(run, SCHEMA)


def _runs(ids, doc, n_docs: int, half: int, min_words: int) -> tuple[list[list], np.ndarray]:
    found: list[list] = [[] for _ in range(n_docs)]
    kept = np.ones(len(ids), bool)
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    cover = covered(ids, doc, half)
    inner = cover[1:] & cover[:-1] & (doc[1:] == doc[:-1])
    lo = np.flatnonzero(cover & np.concatenate(([True], ~inner))[:len(ids)])
    hi = np.flatnonzero(cover & np.concatenate((~inner, [True]))[:len(ids)]) + 1
    for a, b in zip(lo.tolist(), hi.tolist()):
        d = int(doc[a])
        for s, length, q in runs_of(ids[a:b], min_words) if b - a >= min_words else ():
            found[d].append((a + s - int(first[d]), length, q))
            kept[a + s + q:a + s + length] = False
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found], kept


def _collapsed(data, offsets, start, end, doc, kept) -> pa.Array:
    """Kept words joined by one space: their bytes, and the white byte behind each but the last of a document."""
    start, end, doc = start[kept], end[kept], doc[kept]
    mark = np.zeros(len(data) + 1, np.int8)
    mark[start] += 1
    mark[end] -= 1
    stay = np.cumsum(mark[:-1], dtype=np.int8) > 0
    gaps = end[:-1][doc[1:] == doc[:-1]]
    stay[gaps] = True
    out = data.copy()
    out[gaps] = 0x20
    before = np.concatenate(([0], np.cumsum(stay)))
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(before[offsets]),
                                            pa.py_buffer(np.ascontiguousarray(out[stay]))).cast(pa.string())


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): a tenth of the texts repeats a stretch of its words to its end.

    With h = crc32(id), g = h div 10 and n words: where h mod 10 is 0 and n > 0,
    words from a = g mod n on repeat the first p = 1 + (n - a) div (3 + g mod 8)
    of them.  A null id counts as the empty string.
    """
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), h.alias("h"))
    white = " \t\n\x0b\x0c\r"
    ink = F.btrim("text", F.lit(white))
    rows = rows.withColumn("words", F.when((F.col("h") % 10 == 0) & (F.length(ink) > 0),
                                           F.split(ink, "[\\x20\\x09-\\x0D]+")))
    rows = rows.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)})
    rows = rows.withColumn("a", F.when(F.col("words").isNotNull(), (F.col("g") % F.col("n")).cast("int")))
    rest = F.col("n") - F.col("a")
    rows = rows.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")),
                       F.flatten(F.array_repeat(block, F.floor(rest / F.col("p")).cast("int"))),
                       F.slice("words", F.col("a") + 1, (rest % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(F.col("words").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text"))
                       .alias("text"))
