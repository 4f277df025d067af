"""Serving top-N lists per model and the candidate set.

Every model sees the world through one "universe": the users it can score,
the items it ranks, and the pairs it must not recommend again.

* ALS / BPR (warm): users and items of the training period, seen = non-zero
  training cells.
* hybrid (full): users and items of training U evaluation, seen = non-zero
  training cells; cold users exist in the dictionary.
* SVD (ratings): users and items of the training ratings, seen = rated pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import h
from . import ratings as rat
from .factors import FactorModel
from .interactions import raw_cells
from .scoring import score_many
from .splits import PhaseSplits

MODELS = ("als", "bpr", "lightfm", "svd")
SCOPE = {"als": "warm", "bpr": "warm", "lightfm": "full", "svd": "ratings"}


@dataclass
class Universe:
    users: DataFrame      # visitorid
    items: DataFrame      # itemid
    seen: DataFrame       # visitorid, itemid


def universe(sp: PhaseSplits, model: str, ratings: DataFrame | None = None) -> Universe:
    scope = SCOPE[model]
    if scope == "ratings":
        r = ratings if ratings is not None else rat.hybrid_ratings(sp.train)
        r = r.select(F.col("user_id").alias("visitorid"), F.col("item_id").alias("itemid"))
        return Universe(r.select("visitorid").distinct(), r.select("itemid").distinct(), r)
    seen = raw_cells(sp.train).filter(F.col("weight") != 0).select("visitorid", "itemid")
    fit = sp.train if scope == "warm" else sp.train.unionByName(sp.eval_full)
    return Universe(fit.select("visitorid").distinct(), fit.select("itemid").distinct(), seen)


def recommend_many(models: dict[str, FactorModel], uni: Universe, requested: DataFrame, k: int,
                   candidates: DataFrame | None = None, cold: DataFrame | None = None) -> DataFrame:
    """(model, visitorid, rank, itemid, score) for requested visitors the models know (J9), in one scoring job.

    Unknown visitors get no rows; ``recommend_batch`` turns that into an empty list.
    """
    users = requested.select(F.col("visitorid").alias("u")).distinct()
    users = users.join(uni.users.select(F.col("visitorid").alias("u")), "u", "left_semi")
    items = uni.items.select(F.col("itemid").alias("i"))
    if candidates is not None:
        items = items.join(candidates.select(F.col("itemid").alias("i")), "i", "left_semi")
    seen = uni.seen.select(F.col("visitorid").alias("u"), F.col("itemid").alias("i"))
    top = score_many(models, users, k, seen=seen, items=items, cold=cold)
    return top.select("model", F.col("u").alias("visitorid"), "rank", F.col("i").alias("itemid"), "score")


def recommend(model: FactorModel, uni: Universe, requested: DataFrame, k: int,
              candidates: DataFrame | None = None) -> DataFrame:
    """``recommend_many`` of one model: (visitorid, rank, itemid, score)."""
    return recommend_many({"": model}, uni, requested, k, candidates).drop("model")


def valid_items(recs: DataFrame, item_dict: DataFrame) -> DataFrame:
    """Drop recommended items outside the item dictionary."""
    return recs.join(item_dict.select(F.col("raw").alias("itemid")), "itemid", "left_semi")


def recommend_batch(recs: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested LEFT JOIN lists -> (visitorid, n_items, items) with '' for unknown visitors."""
    lists = (recs.groupBy("visitorid")
             .agg(F.sort_array(F.collect_list(F.struct("rank", "itemid"))).alias("_l")))   # <= k per visitor
    return (requested.select("visitorid").distinct().join(lists, "visitorid", "left")
            .select("visitorid",
                    F.coalesce(F.size("_l"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce(F.array_join(F.transform("_l", lambda s: s["itemid"].cast("string")), ","),
                               F.lit("")).alias("items")))


def all_recommendations(per_model: dict[str, DataFrame]) -> DataFrame:
    """The lists of every model, tagged by ``model``."""
    out = None
    for m, recs in per_model.items():
        part = recs.select(F.lit(m).alias("model"), "visitorid", "rank", "itemid")
        out = part if out is None else out.unionByName(part)
    return out


def candidate_items(eval_items: DataFrame, popularity: DataFrame, cap: int | None = None,
                    top_n: int | None = None) -> DataFrame:
    """R6 (U2 + T4): evaluation items U the popular items; all of them unless a limit is asked for.

    popularity: (itemid, cnt).  ``top_n`` keeps only the most popular items
    beside the evaluation items; ``cap`` keeps evaluation items first, then the
    most popular, then the smallest ids.  Blocked scoring bounds memory by
    itself, so neither limit is needed for size.
    """
    top = popularity.select("itemid")
    if top_n is not None:
        top = popularity.orderBy(F.col("cnt").desc(), F.col("itemid").asc()).limit(top_n).select("itemid")
    ev = eval_items.select("itemid").distinct().withColumn("is_eval", F.lit(1))
    cand = (top.withColumn("is_eval", F.lit(0)).unionByName(ev)
            .groupBy("itemid").agg(F.max("is_eval").alias("is_eval"))
            .join(popularity, "itemid", "left")
            .withColumn("cnt", F.coalesce("cnt", F.lit(0)).cast("double")))
    if cap is None:
        return cand
    return (cand.orderBy(F.col("is_eval").desc(), F.col("cnt").desc(), F.col("itemid").asc())
            .limit(cap))


def sample_users(users: DataFrame, n: int | None, seed: int = 42, col: str = "visitorid") -> DataFrame:
    """T5: exactly min(n, |users|) users, seeded, without replacement (all when n is None)."""
    u = users.select(col).distinct()
    if n is None:
        return u
    return u.orderBy(h(F.col(col), seed=seed), F.col(col)).limit(n)


def cold_users(model: FactorModel, users: DataFrame) -> DataFrame:
    """Users (id) that the model has no factor for."""
    return (users.select(F.col("visitorid").alias("id")).distinct()
            .join(model.user_factors.select("id"), "id", "left_anti"))


def with_cold_users(model: FactorModel, users: DataFrame) -> FactorModel:
    """Q23: users the hybrid model never trained on get a zero factor and zero bias,
    so they are ranked by the item biases (a popularity-like order)."""
    first = model.item_factors.select("features").first()                  # one row reaches the driver
    f = len(first["features"]) if first else 0
    missing = cold_users(model, users)
    zeros = missing.select("id", F.lit(0.0).alias("bias"), F.array_repeat(F.lit(0.0), f).alias("features"))
    return FactorModel(model.kind, model.user_factors.unionByName(zeros), model.item_factors,
                       model.global_mean, model.divisor, dict(model.params, cold_users="zero"),
                       item_files=model.item_files)
