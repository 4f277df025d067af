"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared as UTF-8 bytes with A-Z lower-cased and every run of ASCII
white space made one space.  A document is contaminated by an item if some part
of it is within ``edits`` = floor(``ERROR`` * length) byte edits of the item.

1. Items go in blocks of bounded size; tasks write a block's q-grams, one sorted
   array with their places, to the shared folder.
2. Every position of every document is looked up.  A shared q-gram at document
   position p and item position i lies on diagonal p - i; an occurrence with at
   most e edits keeps at least n + 1 - q(e + 1) of the item's n + 1 - q q-grams
   within 2e + 1 neighbouring diagonals (q-gram lemma), so within one of the
   overlapping diagonal bands of twice that width.  Bands with that many
   distinct item positions are retained; all others cannot hold an occurrence.
3. Retained bands are verified by alignment inside the band.

q is 8, and less for items of fewer than 16 bytes: the largest q at which the
lemma still asks for one q-gram, n div (e + 1), so that items of any length are
found with their whole budget.  An item of a few bytes is found wherever they
stand, inside words too.

Documents are neither shuffled nor joined: a task reads them once, some
megabytes at a time, and opens one block of items after the other for these.
Neither the driver nor the plan holds items, whatever their number.

Edge cases: null and empty texts match nothing; items with a null or blank
text or a null id take no part; repeated items are reported once per id, of
equally good places the first; repeated documents one by one; very long texts
are scanned whole; an empty benchmark leaves every document clean; an empty
table gives no rows; extra columns pass through.
"""

from __future__ import annotations

import io
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path
from .arrays import map_array, write_array
from .common import packed
from .textvec import CHUNK_BYTES, LOWER, SPACE, chunks, flat

Q = 8
ERROR = 0.08
#: Bounds of a block of items, i.e. of what a task holds of the benchmark at once.
BLOCK_ITEMS = 4096
BLOCK_BYTES = 4 << 20
#: Text a task holds while it goes through the blocks.
HELD_BYTES = 8 * CHUNK_BYTES
_TABLE_BITS = 22
_ODD = np.uint64(0x9E3779B97F4A7C15)
HITS = "array<struct<item_id:bigint,edits:int,first:bigint,last:bigint>>"
_HIT = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("first", pa.int64()), ("last", pa.int64())]))


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case, one space per run of white space, none in front."""
    space = SPACE[data]
    before = np.concatenate(([True], space[:-1])) if len(data) else space
    begins = offsets[:-1][offsets[:-1] < len(data)]
    before[begins] = True
    keep = ~(space & before)
    out = LOWER[data]
    out[space] = 0x20
    return out[keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


def grams(data: np.ndarray, q: int = Q) -> np.ndarray:
    """The q-gram at every byte, as one 64-bit word (q at most 8)."""
    n = len(data) - q + 1
    if n < 1:
        return np.empty(0, np.uint64)
    data = np.concatenate((data, np.zeros(8 - q, np.uint8)))
    words = np.ndarray((n,), "<u8", buffer=np.ascontiguousarray(data), strides=(1,)).copy()
    return words & np.uint64((1 << 8 * q) - 1)


class Index(NamedTuple):
    q: int
    ids: np.ndarray       # item ids
    text: np.ndarray      # normalised bytes of all items
    start: np.ndarray     # item x is text[start[x]:start[x + 1]]
    edits: np.ndarray
    least: np.ndarray     # distinct shared q-grams the lemma asks for
    codes: np.ndarray     # distinct q-grams, sorted
    first: np.ndarray     # places of codes[c] are places[first[c]:first[c + 1]]
    item: np.ndarray
    place: np.ndarray

    def words(self, x: int) -> np.ndarray:
        return self.text[self.start[x]:self.start[x + 1]]


def build(rows: list[tuple[int, str]], error: float = ERROR) -> list[Index]:
    """One index per q-gram length that the items ask for."""
    by_q: dict[int, list] = {}
    for i, text in sorted(set(rows)):
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        data, _ = normalise(raw, np.array([0, len(raw)]))
        data = np.frombuffer(data.tobytes().rstrip(b" "), np.uint8)
        if len(data):
            e = int(len(data) * error)
            by_q.setdefault(min(Q, len(data) // (e + 1)), []).append((i, data, e))
    return [_index(q, *zip(*items)) for q, items in sorted(by_q.items())]


def _index(q: int, ids, texts, edits) -> Index:
    size, edits = np.array([len(t) for t in texts]), np.array(edits)
    codes = [grams(t, q) for t in texts]
    item = np.repeat(np.arange(len(ids)), [len(c) for c in codes])
    place = np.concatenate([np.arange(len(c)) for c in codes])
    code = np.concatenate(codes)
    order = np.argsort(code, kind="stable")
    code, item, place = code[order], item[order], place[order]
    first = np.concatenate(([0], np.flatnonzero(np.diff(code)) + 1))
    return Index(q, np.array(ids), np.concatenate(texts), np.concatenate(([0], np.cumsum(size))), edits,
                 size + 1 - q * (edits + 1), code[first], np.append(first, len(code)), item, place)


def save(indexes: list[Index], folder: str, name: str) -> None:
    body = io.BytesIO()
    np.savez(body, n=len(indexes), **{f"{k}-{f}": v for k, x in enumerate(indexes) for f, v in x._asdict().items()})
    write_array(folder, name, np.frombuffer(body.getbuffer(), np.uint8))


@lru_cache(1)
def opened(folder: str, name: str) -> list[tuple[Index, np.ndarray]]:
    """The indexes of a block, each with a table of the hashes its q-grams have."""
    out = []
    with np.load(io.BytesIO(map_array(folder, name, np.uint8).tobytes())) as f:
        for k in range(int(f["n"])):
            index = Index(*(int(f[f"{k}-q"]) if x == "q" else f[f"{k}-{x}"] for x in Index._fields))
            out.append((index, table_of(index)))
    return out


def table_of(index: Index) -> np.ndarray:
    """A bit per hash: may be a q-gram of the index."""
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[(index.codes * _ODD) >> np.uint64(64 - _TABLE_BITS)] = True
    return table


def align(item: np.ndarray, text: np.ndarray, low: int, width: int, budget: int) -> tuple[int, int] | None:
    """Best (edits, end) of the item against ``text`` on diagonals low .. low + width - 1, if within budget."""
    n = len(item)
    padded = np.full(n + width, -1, np.int16)               # outside the document nothing matches
    a, b = max(low, 0), min(low + n + width, len(text))
    if b > a:
        padded[a - low:b - low] = text[a:b]
    steps = np.arange(width)
    row = np.zeros(width, np.int64)                          # the item may begin anywhere in the band
    for i in range(n):
        new = row + (padded[i:i + width] != item[i])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps     # insertions, along the row
        if row.min() > budget:
            return None
    end = int(np.argmin(row))
    return int(row[end]), low + n + end


def find(index: Index, table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(text index, item index, edits, first, last) of every item in every normalised text, first best one each."""
    code = grams(data, index.q)
    at = np.flatnonzero(table[(code * _ODD) >> np.uint64(64 - _TABLE_BITS)])
    slot = np.minimum(np.searchsorted(index.codes, code[at]), len(index.codes) - 1)
    same = index.codes[slot] == code[at]
    at, slot = at[same], slot[same]
    doc = np.searchsorted(offsets, at, side="right") - 1
    inside = at + index.q <= offsets[doc + 1]
    at, slot, doc = at[inside], slot[inside], doc[inside]
    # a text must show some item's least number of q-grams at all
    enough = np.bincount(doc, minlength=len(offsets))[doc] >= index.least.min()
    at, slot, doc = at[enough], slot[enough], doc[enough]
    found = []
    begin = 0
    while begin < len(at):                                   # some documents at a time: bounded expansion
        stop = begin + int(np.searchsorted(np.cumsum(index.first[slot[begin:] + 1] - index.first[slot[begin:]]), 1 << 21)) + 1
        stop = min(stop, len(at))
        stop = int(np.searchsorted(doc, doc[stop - 1], side="right"))     # whole documents
        found += _bands(index, data, offsets, at[begin:stop], slot[begin:stop], doc[begin:stop])
        begin = stop
    return found


def _bands(index, data, offsets, at, slot, doc):
    n = index.first[slot + 1] - index.first[slot]
    pick = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(index.first[slot], n)
    item, place = index.item[pick], index.place[pick]
    at, doc = np.repeat(at, n), np.repeat(doc, n)
    items, base = len(index.ids), int(doc[0])
    pair = (doc - base) * items + item
    shared = np.bincount(pair)[pair] >= index.least[item]
    at, doc, item, place = at[shared], doc[shared], item[shared], place[shared]
    if len(at) == 0:
        return []
    stride = 2 * index.edits[item] + 1
    diagonal = at - offsets[doc] - place
    band = diagonal // stride
    rows = [np.concatenate([x, x]) for x in (doc, item, place)] + [np.concatenate([band, band - 1])]
    order = np.lexsort((rows[2], rows[3], rows[1], rows[0]))
    doc, item, place, band = (x[order] for x in rows)
    new = np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(band) != 0)))
    first = np.flatnonzero(new)
    fresh = new | np.concatenate(([True], np.diff(place) != 0))          # distinct item positions
    count = np.add.reduceat(fresh.astype(np.int64), first)
    best = {}
    for f in first[count >= index.least[item[first]]]:
        d, x = int(doc[f]), int(item[f])
        known = best.get((d, x))
        if known and known[0] == 0:
            continue
        text, want, e = data[offsets[d]:offsets[d + 1]], index.words(x), int(index.edits[x])
        low = int(band[f]) * (2 * e + 1)
        width = 2 * (2 * e + 1)
        region = text[max(low, 0):max(low, 0) + len(want) + width].tobytes()
        exact = region.find(want.tobytes())
        if exact >= 0:
            got = (0, max(low, 0) + exact + len(want))
        else:
            got = align(want, text, low, width, e)
        if got and (known is None or got[0] < known[0]):
            best[d, x] = got
    return [(d, x, e, max(end - len(index.words(x)) - e, 0), end) for (d, x), (e, end) in sorted(best.items())]


def write_blocks(benchmark: DataFrame, error: float = ERROR, id_col: str = "item_id",
                 text_col: str = "text") -> tuple[str, int]:
    """Index the items block by block, a task a block; returns the folder and the number of blocks."""
    folder = scratch_path(benchmark.sparkSession, "items")
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where(
        "i IS NOT NULL AND t IS NOT NULL").distinct()       # a repeated row would go whole to one block
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    parts = max(-(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES), 1)

    def write(key, table):
        save(build(list(zip(table.column("i").to_pylist(), table.column("t").to_pylist())), error),
             folder, f"block-{key[0].as_py()}")
        return pa.table({"p": pa.array([key[0].as_py()], pa.int32())})
    part = F.pmod(F.xxhash64("i", "t"), F.lit(parts)).cast("int").alias("p")
    written = {r.p for r in rows.select(part, "i", "t").groupBy("p").applyInArrow(write, "p int").collect()}
    for p in set(range(parts)) - written:                   # no item fell there
        save([], folder, f"block-{p}")
    return folder, parts


def scan(docs: DataFrame, benchmark: DataFrame, error: float = ERROR, id_col: str = "doc_id",
         text_col: str = "text", carry: bool = False) -> DataFrame:
    """(doc_id, contaminated, hits) of every document, with all columns in ``_row`` if ``carry``."""
    ident, text = F.col(id_col).cast("long"), F.col(text_col)
    rows = packed(docs, doc_id=ident, text=text) if carry else docs.select(ident.alias("doc_id"), text.alias("text"))
    folder, parts = write_blocks(benchmark, error)

    def scanned(held):
        clean = [normalise(*flat(b.column("text"))) for b in held]
        hits = [[[] for _ in range(b.num_rows)] for b in held]
        for p in range(parts):
            for index, table in opened(folder, f"block-{p}"):
                for (data, offsets), per in zip(clean, hits):
                    for d, x, e, first, last in find(index, table, data, offsets):
                        per[d].append({"item_id": int(index.ids[x]), "edits": e, "first": first, "last": last})
        for b, per in zip(held, hits):
            per = [sorted(h, key=lambda x: x["item_id"]) for h in per]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(per, _HIT)], names=[*b.schema.names, "hits"])

    def run(batches):
        held, size = [], 0
        for b in chunks(batches):
            held.append(b)
            size += b.column("text").nbytes
            if size >= HELD_BYTES or parts == 1:
                yield from scanned(held)
                held, size = [], 0
        if held:
            yield from scanned(held)
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(f"hits {HITS}").fields])
    found = rows.mapInArrow(run, schema)
    return found.select(*(["_row"] if carry else []), "doc_id", (F.size("hits") > 0).alias("contaminated"), "hits")
