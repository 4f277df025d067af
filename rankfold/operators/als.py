"""M1: implicit ALS (Spark ML, or block files with reports), P11, and M7: fold-in of a user profile.

Spark's implicit ALS weights a cell by confidence 1 + alpha * r
(Hu, Koren, Volinsky 2008) and scales the ridge term by the user's number of
cells (ALS-WR).  Zero-weight cells are dropped before fitting.  Factors are
decoded to raw IDs once, so serving never needs the dictionaries.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.blockfiles import drop_block, load_block, save_block
from .block_sgd import init_matrix
from .cells import Cells, block_ids, cell, factor_rows, hash_block, run_tasks
from .factors import FactorModel


#: Blocks of users and of items: fixed, so that the factors don't depend on the number of cores.
#: Raise it with the data (a block's factors must fit in a task).
ALS_BLOCKS = 10
#: Iterations between checkpoints of the item factors: only then are the shuffles of the iterations before removed,
#: and an iteration ships every factor to each block that needs it.
ALS_CHECKPOINT = 1


def train_als(cells: DataFrame, user_dict: DataFrame, item_dict: DataFrame, rank: int = 64,
              reg: float = 0.1, iterations: int = 20, alpha: float = 1.0, seed: int = 42,
              num_blocks: int = ALS_BLOCKS) -> FactorModel:
    """cells: (user_idx, item_idx, weight) over dense dictionaries (int range required by ALS)."""
    data = (cells.filter(F.col("weight") != 0)
            .select(F.col("user_idx").cast("int").alias("user"), F.col("item_idx").cast("int").alias("item"),
                    F.col("weight").cast("float").alias("rating")))                     # P11
    als = ALS(rank=rank, regParam=reg, maxIter=iterations, implicitPrefs=True, alpha=alpha, seed=seed,
              userCol="user", itemCol="item", ratingCol="rating", numUserBlocks=num_blocks, numItemBlocks=num_blocks,
              coldStartStrategy="drop", checkpointInterval=ALS_CHECKPOINT)
    m = als.fit(data)

    def decode(factors: DataFrame, d: DataFrame) -> DataFrame:
        return (factors.join(d.select(F.col("idx").cast("int").alias("id"), F.col("raw")), "id")
                .select(F.col("raw").alias("id"), F.lit(0.0).alias("bias"),
                        F.transform("features", lambda x: x.cast("double")).alias("features")))
    return FactorModel("dot", decode(m.userFactors, user_dict), decode(m.itemFactors, item_dict),
                       params={"factors": rank, "regularization": reg, "iterations": iterations,
                               "alpha": alpha, "seed": seed, "blocks": num_blocks})


def gram(item_factors: DataFrame, f: int) -> np.ndarray:
    """Y^T Y: one partial f x f product per partition (Arrow batches), summed per cell by Spark.

    Only the f * f result reaches the driver, whatever the number of items.
    """
    def partial(batches):
        g = np.zeros((f, f))
        for pdf in batches:
            if len(pdf):
                Y = np.stack(pdf["features"].to_numpy()).astype(np.float64)
                g += Y.T @ Y
        yield pd.DataFrame({"k": np.arange(f * f, dtype=np.int64), "v": g.ravel()})
    cells = (item_factors.select("features").mapInPandas(partial, "k long, v double")
             .groupBy("k").agg(F.sum("v").alias("v")))
    g = np.zeros(f * f)
    for r in cells.collect():
        g[r["k"]] = r["v"]
    return g.reshape(f, f)


def _weighted_sums(u: np.ndarray, w: np.ndarray, Y: np.ndarray, i: np.ndarray, out: np.ndarray) -> None:
    """out[u] += w * Y[i]; ``u`` rises."""
    for lo in range(0, len(u), 1 << 14):
        at = u[lo:lo + (1 << 14)]
        first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        out[at[first]] += np.add.reduceat(w[lo:lo + (1 << 14), None] * Y[i[lo:lo + (1 << 14)]], first)


def _conjugate(P: np.ndarray, gram: np.ndarray, parts, n_users: int, alpha: float, reg: float, steps: int = 3) -> np.ndarray:
    """``steps`` conjugate-gradient steps from P towards the solutions of the users' normal equations.

    ``parts()`` yields (u rising, i, r, Y) per block of the other side; no f x f matrix is built per user.
    """
    right, count = np.zeros_like(P), np.zeros(n_users)
    for u, i, r, Y in parts():
        _weighted_sums(u, (1.0 + alpha * np.abs(r)) * (r > 0), Y, i, right)
        count += np.bincount(u, minlength=n_users)

    def times(x):
        out = x @ gram + (reg * count)[:, None] * x
        for u, i, r, Y in parts():
            dot = np.empty(len(u))
            for lo in range(0, len(u), 1 << 14):
                dot[lo:lo + (1 << 14)] = np.einsum("nf,nf->n", Y[i[lo:lo + (1 << 14)]], x[u[lo:lo + (1 << 14)]])
            _weighted_sums(u, alpha * np.abs(r) * dot, Y, i, out)
        return out
    P = np.where(count[:, None] > 0, P, 0.0)
    rest = right - times(P)
    move, size = rest.copy(), (rest * rest).sum(axis=1)
    for _ in range(steps):
        ahead = times(move)
        below = (move * ahead).sum(axis=1)
        a = np.divide(size, below, out=np.zeros_like(size), where=(size > 1e-20) & (below > 0))
        P = P + a[:, None] * move
        rest = rest - a[:, None] * ahead
        new = (rest * rest).sum(axis=1)
        move = rest + np.divide(new, size, out=np.zeros_like(size), where=size > 1e-20)[:, None] * move
        size = new
    return P


@dataclass(frozen=True)
class AlsFit:
    """One implicit ALS model; ``report`` lists iterations after which its factors are kept (the last one always is)."""
    factors: int
    reg: float
    iterations: int
    alpha: float = 1.0
    seed: int = 42
    report: tuple[int, ...] = ()

    @property
    def kept(self) -> tuple[int, ...]:
        return tuple(sorted({*self.report, self.iterations}))


def fit_als_blocks(rows: DataFrame, fits: list[AlsFit], blocks: int | None = None) -> list[dict[int, FactorModel]]:
    """Implicit ALS over block files: the objective of ``train_als``, solved by conjugate gradients (Takacs et al. 2011).

    rows: (u, i, r) with raw ids; zeros are dropped.  Unlike Spark ML's ALS it
    reports the factors after any of its iterations, and it trains several fits
    in the same jobs.  A half-iteration is one flat job over (fit, block); with
    one block a fit runs in one task.  A task holds one block of its own side
    and one block of the other side at a time.
    """
    c = Cells(rows.filter(F.col("r") != 0), blocks)
    folder, nb, spark = c.folder, c.blocks, rows.sparkSession

    def load(n: int, side: str, block: int, t: int) -> tuple[np.ndarray, np.ndarray]:
        if t:
            f = load_block(folder, f"{n}-{side[0]}-{block}-{t}")
            return f["ids"], f["m"]
        ids = block_ids(folder, side, block)
        return ids, init_matrix(ids, fits[n].factors, side, fits[n].seed, True, 0.1)

    def half(n: int, side: str, block: int, t: int, memory: dict | None = None) -> None:
        """Iteration t + 1 of one side: users first, from the items of iteration t, then items from these users."""
        fit, other = fits[n], "item" if side == "user" else "user"
        other_t = t if side == "user" else t + 1
        ids, m = memory[side] if memory else load(n, side, block, t)
        cells = {}

        def parts():
            for k in range(nb):
                theirs, Y = memory[other] if memory else load(n, other, k, other_t)
                if k not in cells or nb > 1:
                    a, b = (block, k) if side == "user" else (k, block)
                    x, y = (ids, theirs) if side == "user" else (theirs, ids)
                    u, i, _, _, r = cell(folder, a, b, x, y)
                    if side == "item":
                        order = np.argsort(i, kind="stable")
                        u, i, r = i[order], u[order], r[order]
                    cells[k] = (u, i, r)
                if len(cells[k][0]):
                    yield *cells[k], Y
        if memory:
            cells = memory["cells"][side]
        grams = sum((lambda Y: Y.T @ Y)(memory[other][1] if memory else load(n, other, k, other_t)[1]) for k in range(nb))
        m = _conjugate(m, grams, parts, len(ids), fit.alpha, fit.reg)
        if memory:
            memory[side] = (ids, m)
        if not memory or t + 1 in fit.kept:
            save_block(folder, f"{n}-{side[0]}-{block}-{t + 1}", ids=ids, m=m, b=np.zeros(len(ids)))
        if not memory and t > 1 and t - 1 not in fit.kept:
            drop_block(folder, f"{n}-{side[0]}-{block}-{t - 1}")

    def whole(n: int) -> None:
        memory = {s: load(n, s, 0, 0) for s in ("user", "item")} | {"cells": {"user": {}, "item": {}}}
        for t in range(fits[n].iterations):
            half(n, "user", 0, t, memory)
            half(n, "item", 0, t, memory)
    heavy = sorted(range(len(fits)), key=lambda n: -fits[n].factors ** 2 * fits[n].iterations)
    if nb == 1:
        run_tasks(spark, heavy, whole)
    else:
        for t in range(max(f.iterations for f in fits)):
            for side in ("user", "item"):
                run_tasks(spark, [(n, k) for n in heavy if fits[n].iterations > t for k in range(nb)],
                          lambda x, t=t, side=side: half(x[0], side, x[1], t))

    def model(n: int, t: int) -> FactorModel:
        f = fits[n]
        user, item = ([f"{n}-{s}-{k}-{t}" for k in range(nb)] for s in "ui")
        return FactorModel("dot", factor_rows(spark, folder, user), factor_rows(spark, folder, item),
                           user_files=[(folder, x) for x in user], item_files=[(folder, x) for x in item], params={"factors": f.factors, "regularization": f.reg, "iterations": t,
                                   "alpha": f.alpha, "seed": f.seed, "blocks": nb})
    return [{t: model(n, t) for t in f.kept} for n, f in enumerate(fits)]


#: Users of a fold-in task; their f x f sums are held in parts of at most SUM_BYTES.
FOLD_USERS = 2_048
SUM_BYTES = 64 << 20


def fold_in(profile: DataFrame, item_factors: DataFrame, reg: float, alpha: float = 1.0,
            blocks: int | None = None) -> DataFrame:
    """M7: re-solve each user's factor from a profile (visitorid, itemid, weight).

    x_u = (Y^T Y + Y^T (C_u - I) Y + reg * n_u I)^-1 Y^T C_u p_u, i.e. the same
    normal equations as the ALS user step.  Profile cells are cut into (user
    block, item block) files and item factors into block files, so no factor is
    joined to a cell.  A task adds up the equations of its users one item block
    after the other: a user with cells on every item costs one block's rows at a
    time.  Users without a cell on a known item get no row.
    """
    spark = profile.sparkSession
    f = len(item_factors.select("features").first()["features"])
    yty = gram(item_factors, f)                                # f x f, independent of the data size
    c = Cells(profile.filter(F.col("weight") != 0).select(F.col("visitorid").alias("u"), F.col("itemid").alias("i"),
                                                          F.col("weight").alias("r")), blocks)
    folder, nb = c.folder, c.blocks

    def write(key, table):
        ids = table.column("id").to_numpy()
        order = np.argsort(ids)
        m = table.column("features").combine_chunks().flatten().to_numpy().reshape(len(ids), f)
        save_block(folder, f"fold-{key[0].as_py()}", ids=ids[order], m=m[order])
        return pa.table({"n": pa.array([len(ids)], pa.int64())})
    known = item_factors.select(hash_block(F.col("id"), nb, "item").alias("block"), "id", "features")
    known.groupBy("block").applyInArrow(write, "n long").agg(F.sum("n")).collect()
    slices = max(1, -(-c.n_users // (nb * FOLD_USERS)))

    def solve(task: tuple[int, int]) -> None:
        a, s = task
        ids = block_ids(folder, "user", a)
        lo, hi = len(ids) * s // slices, len(ids) * (s + 1) // slices
        step = max(1, SUM_BYTES // (8 * f * f))
        out, cells = np.zeros((hi - lo, f)), np.zeros(hi - lo, np.int64)
        for x in range(lo, hi, step):
            y = min(x + step, hi)
            A, right, n = np.zeros((y - x, f, f)), np.zeros((y - x, f)), np.zeros(y - x, np.int64)
            for b in range(nb):
                items = load_block(folder, f"fold-{b}")
                if items is None:
                    continue
                u, i, _, raw, r = cell(folder, a, b, ids, items["ids"])
                p, q = np.searchsorted(u, [x, y])
                u, i, raw, r = u[p:q] - x, np.minimum(i[p:q], len(items["ids"]) - 1), raw[p:q], r[p:q]
                fine = items["ids"][i] == raw                      # items without a factor are left out
                u, i, r = u[fine], i[fine], r[fine]
                first = np.flatnonzero(np.diff(u, prepend=-1))
                for k, e in zip(first, np.append(first[1:], len(u))):
                    Y, w = items["m"][i[k:e]], alpha * np.abs(r[k:e])
                    A[u[k]] += (Y.T * w) @ Y
                    right[u[k]] += ((1.0 + w) * (r[k:e] > 0)) @ Y
                    n[u[k]] += e - k
            A += yty + (reg * n)[:, None, None] * np.eye(f)
            some = np.flatnonzero(n)
            if len(some):
                out[x - lo + some] = np.linalg.solve(A[some], right[some, :, None])[:, :, 0]
            cells[x - lo:y - lo] = n
        got = cells > 0
        save_block(folder, f"folded-{a}-{s}", ids=ids[lo:hi][got], m=out[got], b=np.zeros(int(got.sum())))
    run_tasks(spark, [(a, s) for a in range(nb) for s in range(slices)], solve)
    return factor_rows(spark, folder, [f"folded-{a}-{s}" for a in range(nb) for s in range(slices)])
