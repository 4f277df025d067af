"""Approximate nearest neighbours by collision counting over single projections.

Nearness is the inner product.  A vector x becomes x' = (x / M, sqrt(1 - |x|^2 / M^2)),
M the largest norm, and a query q' = (q / |q|, 0): the order by inner product
is then the order by distance.  Every vector is projected on
``PROJECTIONS`` random lines; per line the projections are one sorted array.

Widths are chosen per query, after the fact; no bucket is fixed beforehand.  A
query opens a window centred on its own projection in every array and widens
all windows together by ``GROWTH`` (virtual rehashing: no array is rebuilt).  A
vector inside the windows of at least ``THRESHOLD`` of the lines has collided
often enough and is verified by its exact inner product.  Widening ends when
``CANDIDATES`` of a block's vectors (at least ``LEAST``) were verified or the
windows hold everything; every vector beyond the threshold at that width is
verified, so equal vectors are found together.  Rows of the query's own id do
not count towards that number.  Where windows hold most of an
array, what lies outside them is counted instead.

Vectors are dealt by id hash into blocks of about ``BLOCK`` rows, whose matrices
are one row each; the stated query set (ids divisible by ``EVERY``) meets every
block in blocks of its own, each of its (id, vector) once.  A cell returns each
query's best k rows; a second step merges k per cell by their row numbers.  Memory follows the block sizes; no pair of vectors is a row.

Edge cases: vectors that are null, zero, empty or hold null or non-finite
components take no part; vectors meet only vectors of their own length; a null
id takes no part; rows that repeat an id are candidates each on their own,
also if their vectors are equal; the query's id is no candidate of its own; a
query id with several vectors has one list, in which a row counts once, by its
best inner product; with fewer candidates than k all
are returned; ties go to the smaller id; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

K = 20
EVERY = 20
PROJECTIONS = 96
THRESHOLD = 0.85
GROWTH = 1.1
#: First half-width of the windows, in standard deviations of the projections.
FIRST_WIDTH = 1.6
CANDIDATES = 0.12
LEAST = 200
BLOCK = 16384
QUERY_BLOCK = 1024
SEED = 7


def lines(dim: int, m: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim + 1, m))


class Block:
    """Sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float):
        self.ids, self.vectors = ids, vectors.astype(np.float64)
        self.sorted_ids = np.sort(ids)
        unit = self.vectors / longest
        rest = np.sqrt(np.maximum(1 - (unit * unit).sum(axis=1), 0))
        h = np.column_stack([unit, rest]) @ lines(vectors.shape[1])
        self.order = np.argsort(h, axis=0, kind="stable").T.copy()
        self.sorted = np.sort(h, axis=0).T.copy()
        self.width = FIRST_WIDTH * float(h.std(axis=0).mean() or 1.0)

    def search(self, qids: np.ndarray, queries: np.ndarray, k: int = K):
        """Per query (places in the block, inner products) of the best k among the vectors that collide often enough."""
        n, m = len(self.ids), len(self.sorted)
        unit = queries / np.sqrt((queries * queries).sum(axis=1))[:, None]
        centre = (np.column_stack([unit, np.zeros(len(unit))]) @ lines_of(queries.shape[1])).T
        misses = m - int(np.ceil(THRESHOLD * m))            # lines on which a candidate may lie outside
        own = np.searchsorted(self.sorted_ids, qids, "right") - np.searchsorted(self.sorted_ids, qids, "left")
        quota = np.minimum(max(LEAST, k + 1, int(CANDIDATES * n)), n - own)
        found: list = [None] * len(queries)
        active, r = np.arange(len(queries)), self.width
        while len(active):
            lo = np.array([np.searchsorted(s, c[active] - r, "left") for s, c in zip(self.sorted, centre)])
            hi = np.array([np.searchsorted(s, c[active] + r, "right") for s, c in zip(self.sorted, centre)])
            inside = (hi - lo).sum(axis=0)
            done = np.zeros(len(active), bool)
            for i, at in enumerate(active):
                a, b = lo[:, i].tolist(), hi[:, i].tolist()
                if 2 * inside[i] <= n * m:                  # count the shorter parts of the arrays
                    count = np.bincount(np.concatenate([o[x:y] for o, x, y in zip(self.order, a, b)]), minlength=n)
                    hit = np.flatnonzero(count >= m - misses)
                else:
                    parts = [o[:x] for o, x in zip(self.order, a)] + [o[y:] for o, y in zip(self.order, b)]
                    hit = np.flatnonzero(np.bincount(np.concatenate(parts), minlength=n) <= misses)
                hit = hit[self.ids[hit] != qids[at]]
                if len(hit) >= quota[at] or inside[i] == n * m:
                    found[at] = self.verify(hit, queries[at], k)
                    done[i] = True
            active, r = active[~done], r * GROWTH
        return found

    def verify(self, hit: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        rough = self.vectors.take(hit, axis=0) @ q
        if len(hit) > k:                                    # all that may tie with the k-th stay
            kth = np.partition(rough, len(rough) - k)[len(rough) - k]
            hit = hit[rough >= kth - 1e-9 * max(1.0, float(np.abs(rough).max()))]
        score = (self.vectors[hit] * q).sum(axis=1)         # row by row: equal vectors score equally
        best = np.lexsort((self.ids[hit], -score))[:k]
        return hit[best], score[best]


_LINES: dict[int, np.ndarray] = {}


def lines_of(dim: int) -> np.ndarray:
    if dim not in _LINES:
        _LINES[dim] = lines(dim)
    return _LINES[dim]


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, v, d): ids, double vectors and their lengths, without the vectors that take no part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("v", lambda x: x != 0)
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine & some).withColumn("d", F.size("v"))


def _matrices(rows: DataFrame, key: str) -> DataFrame:
    """One row per (d, key): ids, row numbers and the matrix, as bytes."""
    def run(_, table):
        d, block = table.column("d")[0].as_py(), table.column(key)[0].as_py()
        values = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table({"d": pa.array([d], pa.int32()), key: pa.array([block], pa.int32()),
                         "ids": pa.array([table.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "rows": pa.array([table.column("row").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "m": pa.array([values.astype("<f8").tobytes()], pa.binary())})
    return rows.groupBy("d", key).applyInArrow(run, f"d int, {key} int, ids binary, rows binary, m binary")


def search(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query, nearest first."""
    good = stored(usable(vectors, id_col, vec_col), "ann-vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    stats = {r.d: (r.n, r.q, r.longest) for r in good.groupBy("d").agg(      # one row per vector length
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("id") % every == 0, 1)).alias("q"),
        F.max(norm).alias("longest")).collect()}
    parts = {d: (-(-n // BLOCK), max(-(-q // QUERY_BLOCK), 1)) for d, (n, q, _) in stats.items()}
    longest = {d: x for d, (_, _, x) in stats.items()}

    def by_length(i: int):
        pairs = [x for d, p in parts.items() for x in (F.lit(d), F.lit(p[i]))] or [F.lit(0), F.lit(1)]
        return F.create_map(*pairs)[F.col("d")]
    # the running number of the row in the hash spreads repeated ids over the blocks too
    base = good.withColumn("row", F.monotonically_increasing_id())
    base = _matrices(base.withColumn("xb", F.pmod(F.xxhash64("id", "row"), by_length(0)).cast("int")), "xb")
    ask = good.where(F.col("id") % every == 0).dropDuplicates(["id", "v"]).withColumn("row", F.xxhash64("id", "v"))
    ask = _matrices(ask.withColumn("qb", F.pmod("row", by_length(1)).cast("int")), "qb")
    base = stored(base, "ann-base")
    ask = ask.drop("rows").withColumnsRenamed({"ids": "qids", "m": "qm"})
    ask = ask.withColumn("xb", F.explode(F.sequence(F.lit(0), by_length(0).cast("int") - 1)))     # query blocks x blocks
    cells = base.join(ask, ["d", "xb"]).select("d", "xb", "ids", "rows", "m", "qids", "qm")

    def run(batches):
        last, block = None, None
        for batch in batches:
            for row in batch.to_pylist():
                d = row["d"]
                if last != (d, row["xb"]):
                    block = Block(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["m"], "<f8").reshape(-1, d), longest[d])
                    last = d, row["xb"]
                queries = np.frombuffer(row["qm"], "<f8").reshape(-1, d)
                out = ([], [], [], [])
                qids, rows = np.frombuffer(row["qids"], "<i8"), np.frombuffer(row["rows"], "<i8")
                for qid, (at, score) in zip(qids, block.search(qids, queries, k)):
                    for col, v in zip(out, (np.full(len(at), qid), block.ids[at], rows[at], score)):
                        col.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([*c, np.empty(0, t)]).astype(t)) for c, t in zip(out, ("<i8", "<i8", "<i8", "<f8"))],
                    names=["query_id", "vec_id", "row", "score"])
    found = cells.mapInArrow(run, "query_id long, vec_id long, row long, score double")
    found = found.groupBy("query_id", "vec_id", "row").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
