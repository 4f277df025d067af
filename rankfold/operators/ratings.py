"""Hybrid implicit + drawn explicit ratings.

1. base rating per event (view 1, addtocart 2, transaction 3), max per (user, item);
2. among the distinct purchased pairs, exactly floor(pct * n) are picked: the
   ones with the smallest ``h(user, item, 'pick', seed)``;
3. each picked pair draws a rating 1..5 with the given probabilities from
   ``h(user, item, 'rate', seed)``; the drawn rating replaces the base one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import h, uniform
from .ranking import global_index

# fixed values: event -> base rating, and the rating draw probabilities for 1..5
BASE_RATING = {"view": 1, "addtocart": 2, "transaction": 3}
RATING_PROBS = (0.2, 0.2, 0.2, 0.3, 0.1)


def base_rating(event: Column) -> Column:
    """P5: unknown labels map to null."""
    expr = None
    for label, r in BASE_RATING.items():
        expr = (F.when(event == label, F.lit(r)) if expr is None else expr.when(event == label, F.lit(r)))
    return expr


def base_ratings(events: DataFrame) -> DataFrame:
    """Strongest signal per (visitorid, itemid)."""
    return (events.select("visitorid", "itemid", base_rating(F.col("event")).alias("base_rating"))
            .groupBy("visitorid", "itemid").agg(F.max("base_rating").alias("rating")))


def purchases(events: DataFrame) -> DataFrame:
    """P4 + U7: distinct purchased (visitorid, itemid)."""
    return events.filter(F.col("event") == "transaction").select("visitorid", "itemid").distinct()


def draw_rating(u: Column, probs=RATING_PROBS) -> Column:
    """Categorical draw from a uniform via cumulative thresholds."""
    acc = 0.0
    expr = None
    for r, p in enumerate(probs[:-1], start=1):
        acc = round(acc + p, 10)
        expr = F.when(u < F.lit(acc), F.lit(r)) if expr is None else expr.when(u < F.lit(acc), F.lit(r))
    return expr.otherwise(F.lit(len(probs)))


def pick_fraction(pairs: DataFrame, pct: float, seed: int) -> DataFrame:
    """Exactly floor(pct * n) pairs, chosen by hash order (a total order)."""
    # 60-bit hash: the top 12 bits name one of 4096 buckets, of which only the one the cut falls into is ordered
    keyed = (pairs.withColumn("_h", h(F.col("visitorid"), F.col("itemid"), F.lit("pick"), seed=seed))
             .withColumn("_b", F.shiftright("_h", 48)))
    counts = {r["_b"]: r["count"] for r in keyed.groupBy("_b").count().collect()}       # at most 4096 rows
    left, cut = int(sum(counts.values()) * pct), -1
    for cut in sorted(counts):
        if counts[cut] > left:
            break
        left -= counts[cut]
    else:
        cut = 1 << 12
    whole = keyed.filter(F.col("_b") < F.lit(cut)).drop("_h", "_b")
    if left == 0:
        return whole
    part = global_index(keyed.filter(F.col("_b") == F.lit(cut)),
                        [F.col("_h").asc(), F.col("visitorid").asc(), F.col("itemid").asc()], "_rk")
    return whole.unionByName(part.filter(F.col("_rk") < F.lit(left)).drop("_h", "_b", "_rk"))


def explicit_draws(events: DataFrame, pct: float = 0.2, seed: int = 42, probs=RATING_PROBS) -> DataFrame:
    """(visitorid, itemid, explicit_rating) for the picked purchases."""
    picked = pick_fraction(purchases(events), pct, seed)
    u = uniform(F.col("visitorid"), F.col("itemid"), F.lit("rate"), seed=seed)
    return picked.withColumn("explicit_rating", draw_rating(u, probs))


def hybrid_ratings(events: DataFrame, pct: float = 0.2, seed: int = 42, probs=RATING_PROBS) -> DataFrame:
    """G1 (+ J5, X1): (user_id, item_id, rating int)."""
    base = base_ratings(events)
    drawn = explicit_draws(events, pct, seed, probs)
    return (base.join(drawn, ["visitorid", "itemid"], "left")
            .select(F.col("visitorid").alias("user_id"), F.col("itemid").alias("item_id"),
                    F.coalesce(F.col("explicit_rating"), F.col("rating")).cast("int").alias("rating")))


def rating_stats(ratings: DataFrame) -> DataFrame:
    """A18 + A19: users, items, ratings, global mean (0.0 when empty)."""
    return ratings.agg(
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("item_id").alias("n_items"),
        F.count(F.lit(1)).alias("n_ratings"),
        F.coalesce(F.avg("rating"), F.lit(0.0)).alias("global_mean"),
    )
