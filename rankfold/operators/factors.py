"""One factor-model layout for every model, plus M5 / M6 pair prediction.

user_factors(id, bias, features array<double>), item_factors(id, bias, features)
and scalars: score = mu + (bu + bi + p.q) / divisor, optionally clipped.
ALS / BPR use plain p.q (kind "dot"), the hybrid model adds both biases
(kind "biased"), SVD adds the global mean and clips to [1, 5] (kind "svd").
Factor tables are keyed by raw IDs: dense indices are decoded once at fit time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from ..functions.hashing import frozen_bias, frozen_factor
from ..session import scratch_path
from ..sources.blockfiles import load_block, save_block
from .cells import hash_block

CLIP = {"svd": (1.0, 5.0)}


@dataclass
class FactorModel:
    kind: str                      # "dot" | "biased" | "svd"
    user_factors: DataFrame
    item_factors: DataFrame
    global_mean: float = 0.0
    divisor: float = 1.0
    params: dict = field(default_factory=dict)
    #: (folder, file) of the blocks behind the two tables, where they are block files.
    user_files: list | None = None
    item_files: list | None = None

    @property
    def clip(self):
        return CLIP.get(self.kind)


def dot(p: Column, q: Column) -> Column:
    """p . q as a JVM-side higher-order expression."""
    return F.aggregate(F.zip_with(p, q, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


def score_expr(m: FactorModel, bu: Column, bi: Column, p: Column, q: Column) -> Column:
    raw = dot(p, q)
    if m.kind != "dot":
        raw = bu + bi + raw
    est = F.lit(m.global_mean) + raw / F.lit(m.divisor)
    if m.clip:
        est = F.greatest(F.lit(m.clip[0]), F.least(F.lit(m.clip[1]), est))    # F7
    return est


#: Ids of a factor block, and pairs of a task, where pairs are scored block by block.
PAIR_IDS = 131_072
PAIR_ROWS = 200_000


class FactorBlocks:
    """The factors of a model as block files of hashed ids, for ``predict_pairs`` over up to about ``rows`` pairs.

    A model that was trained over block files is used as it is; other factors
    are shuffled once into files of the shared folder.
    """

    def __init__(self, m: FactorModel, rows: int, ids_per_block: int = PAIR_IDS):
        self.model, self.rows = m, rows
        self.files = {side: self._files(side, ids_per_block) for side in ("user", "item")}

    def _files(self, side: str, ids_per_block: int) -> list[tuple[str, str]]:
        files, rows = getattr(self.model, f"{side}_files"), getattr(self.model, f"{side}_factors")
        if files is not None:
            return files
        folder = scratch_path(rows.sparkSession, "pairs")
        rows = rows.where("id IS NOT NULL AND features IS NOT NULL")
        nb = max(1, math.ceil(rows.select("id").count() / ids_per_block))

        def write(key, table):
            ids, bias = table.column("id").to_numpy(), table.column("bias").to_numpy()
            m = table.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            order = np.argsort(ids, kind="stable")
            save_block(folder, f"{side}-{key[0].as_py()}", ids=ids[order], m=m[order], b=bias[order])
            return pa.table({"n": pa.array([len(ids)], pa.int64())})
        (rows.select(hash_block(F.col("id"), nb, side).alias("block"), "id", F.col("bias").cast("double").alias("bias"),
                     "features").groupBy("block").applyInArrow(write, "n long").agg(F.sum("n")).collect())
        return [(folder, f"{side}-{k}") for k in range(nb)]


def _places(found: dict | None, col) -> tuple[np.ndarray, np.ndarray]:
    """Place of each id of the column in a block, and whether it is there."""
    there = col.is_valid().to_numpy()
    if found is None or len(found["ids"]) == 0:
        return np.zeros(len(there), np.int64), np.zeros(len(there), bool)
    raw = col.fill_null(0).to_numpy()
    at = np.minimum(np.searchsorted(found["ids"], raw), len(found["ids"]) - 1)
    return at, there & (found["ids"][at] == raw)


def _predict_by_block(blocks: FactorBlocks, pairs: DataFrame, user: str, item: str) -> DataFrame:
    """``predict_pairs`` with a task per (user block, item block), or several where it has many pairs: ids are shuffled, factors are not."""
    m, files = blocks.model, blocks.files
    dot_only, mu, divisor, clip = m.kind == "dot", float(m.global_mean), float(m.divisor), m.clip
    nu, ni = len(files["user"]), len(files["item"])
    slices = max(1, math.ceil(blocks.rows / (nu * ni * PAIR_ROWS)))
    kept = pairs.columns

    def score(key, table):
        U, V = (load_block(*files[side][key[n].as_py()], ("ids", "m", "b")) for n, side in enumerate(("user", "item")))
        (u, known), (i, also) = (_places(x, table.column(c)) for x, c in ((U, user), (V, item)))
        known &= also
        est, rows = np.full(table.num_rows, mu), np.flatnonzero(known)
        for lo in range(0, len(rows), 1 << 14):
            at = rows[lo:lo + (1 << 14)]
            raw = np.einsum("nf,nf->n", U["m"][u[at]], V["m"][i[at]])
            if not dot_only:
                raw = U["b"][u[at]] + V["b"][i[at]] + raw
            x = mu + raw / divisor
            est[at] = x if clip is None else np.maximum(clip[0], np.fmin(clip[1], x))      # F7; NaN is above all, as in SQL
        return pa.table([*(table.column(c) for c in kept), pa.array(est), pa.array(~known)],
                        names=[*kept, "est", "was_impossible"])
    schema = StructType([*pairs.schema.fields]).add("est", DoubleType()).add("was_impossible", BooleanType())
    return (pairs.withColumn("_a", hash_block(F.col(user), nu, "user")).withColumn("_b", hash_block(F.col(item), ni, "item"))
            .withColumn("_s", F.pmod(F.xxhash64(F.col(user), F.col(item), F.lit(3)), F.lit(slices)).cast("int"))
            .groupBy("_a", "_b", "_s").applyInArrow(score, schema))


def predict_pairs(m: FactorModel, pairs: DataFrame, user: str = "visitorid", item: str = "itemid",
                  blocks: FactorBlocks | None = None) -> DataFrame:
    """M5/M6: (user, item) -> est; unknown user or item -> global mean, was_impossible.

    With the model's ``blocks`` no factor is joined to a pair: for many pairs, of which each would carry two factors
    through the shuffles.
    """
    if blocks is not None:
        return _predict_by_block(blocks, pairs, user, item)
    uf = m.user_factors.select(F.col("id").alias(user), F.col("bias").alias("_bu"), F.col("features").alias("_p"))
    itf = m.item_factors.select(F.col("id").alias(item), F.col("bias").alias("_bi"), F.col("features").alias("_q"))
    j = pairs.join(uf, user, "left").join(itf, item, "left")
    impossible = F.col("_p").isNull() | F.col("_q").isNull()
    return j.select(*pairs.columns,
                    F.when(impossible, F.lit(m.global_mean))
                    .otherwise(score_expr(m, F.col("_bu"), F.col("_bi"), F.col("_p"), F.col("_q"))).alias("est"),
                    impossible.alias("was_impossible"))


# fixed values: frozen-factor fixture parameters
FROZEN_DIMS = 4
FROZEN_SEED = 42
FROZEN_KIND = {"als": "dot", "bpr": "dot", "lightfm": "biased", "svd": "svd"}


def frozen_table(ids: DataFrame, tag: str, side: str, id_col: str = "raw") -> DataFrame:
    ident = F.col(id_col)
    return ids.select(
        ident.alias("id"),
        frozen_bias(tag, side, ident, seed=FROZEN_SEED).alias("bias"),
        F.array(*[frozen_factor(tag, side, ident, d, seed=FROZEN_SEED) for d in range(FROZEN_DIMS)]).alias("features"),
    )


def frozen_model(tag: str, user_ids: DataFrame, item_ids: DataFrame, id_col: str = "raw",
                 kind: str | None = None) -> FactorModel:
    """Deterministic integer factors so scores are exact in every engine.

    SVD: est = clip(3 + (bu + bi + p.q) / 100).
    """
    kind = kind or FROZEN_KIND[tag]
    mu, div = (3.0, 100.0) if kind == "svd" else (0.0, 1.0)
    return FactorModel(kind, frozen_table(user_ids, tag, "user", id_col), frozen_table(item_ids, tag, "item", id_col),
                       global_mean=mu, divisor=div, params={"frozen": tag})
