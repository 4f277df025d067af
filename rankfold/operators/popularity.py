"""Popularity counts and the popularity recommender.

R1 never forms the users x pool candidate product.  Items get one global
popularity rank (count desc, itemid asc).  For a user with sorted seen ranks
r_1 < r_2 < ..., the number of unseen ranks below r_j is g_j = r_j - j, and the
unseen ranks between r_j and r_{j+1} have list positions g_j + 1 ... .  So the
k unseen top ranks are read off the gaps of the (short) prefix of seen ranks
with g_j < k; a sentinel r_0 = 0 covers users with nothing seen.  Output is
exactly min(k, pool - |seen in pool|) rows per user, and the only per-user
state is a window over that user's distinct seen items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import global_index


def item_popularity(events: DataFrame, item_col: str = "itemid", by: str | None = None) -> DataFrame:
    """Rows per item, or sum of ``by`` per item. Null keys dropped."""
    base = events.filter(F.col(item_col).isNotNull())
    if by is None:
        return base.groupBy(item_col).agg(F.count(F.lit(1)).alias("cnt"))
    return base.groupBy(item_col).agg(F.sum(by).cast("double").alias("cnt"))


def popularity_ranks(pop: DataFrame, item_col: str = "itemid") -> DataFrame:
    """(item, cnt, pop_rank 1-based) in (cnt desc, item asc) order."""
    ranked = global_index(pop, [F.col("cnt").desc(), F.col(item_col).asc()], "pop_rank")
    return ranked.withColumn("pop_rank", F.col("pop_rank") + 1)


def top_popular(pop: DataFrame, n: int, item_col: str = "itemid") -> DataFrame:
    """The n most popular items (TakeOrderedAndProject)."""
    return pop.orderBy(F.col("cnt").desc(), F.col(item_col).asc()).limit(n)


def user_activity(events: DataFrame) -> DataFrame:
    return events.filter(F.col("visitorid").isNotNull()).groupBy("visitorid").agg(F.count(F.lit(1)).alias("n_events"))


def most_active_user(events: DataFrame) -> DataFrame:
    """Max events of one user and that user (ties -> smallest id)."""
    act = user_activity(events)
    return act.agg(F.max("n_events").alias("max_events"),
                   F.min_by("visitorid", F.struct((-F.col("n_events")).alias("n"), F.col("visitorid"))).alias("visitorid"))


#: The ranked pool is broadcast up to this many (item, rank) rows, about 32 MB; beyond it joins are salted.
POOL_BROADCAST_ROWS = 1_000_000
_SALTS = 32


def _join_pool(rows: DataFrame, ranks: DataFrame, pool: int, on: str) -> DataFrame:
    """``rows`` (visitorid, ...) with the pool's (itemid, pop_rank); ``pool`` bounds its rows.

    Few ranks meet most visitors, so a shuffled join on ``on`` alone would
    land in a few tasks: rows are salted by visitor and the pool is repeated.
    """
    side = ranks.filter(F.col("pop_rank") <= pool).select("itemid", "pop_rank")
    if pool <= POOL_BROADCAST_ROWS:
        return rows.join(F.broadcast(side), on)
    side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return (rows.withColumn("_salt", F.pmod(F.xxhash64("visitorid"), F.lit(_SALTS)).cast("int"))
            .join(side, [on, "_salt"]).drop("_salt"))


def recommend_popular(train: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """Per requested user, the k most popular training items the user has not seen.

    ``users``: one column ``visitorid``.  Pool = max events of one training
    user + k, as in the reference.  Returns (visitorid, rank 1..k, itemid, pop_rank).
    """
    ranks = popularity_ranks(item_popularity(train))
    max_events = user_activity(train).agg(F.max("n_events")).first()[0] or 0
    pool = int(max_events) + k
    users = users.select("visitorid").distinct()
    seen = (train.select("visitorid", "itemid").distinct()
            .join(users, "visitorid", "left_semi"))
    seen = _join_pool(seen, ranks, pool, "itemid").select("visitorid", F.col("pop_rank").alias("r"))
    marks = seen.unionByName(users.select("visitorid", F.lit(0).cast("long").alias("r")))
    w = Window.partitionBy("visitorid").orderBy("r")
    gaps = (marks.withColumn("j", F.row_number().over(w) - 1)
            .withColumn("r_next", F.lead("r").over(w))
            .withColumn("g", F.col("r") - F.col("j"))
            .filter(F.col("g") < k))
    hi = F.least(F.coalesce(F.col("r_next") - 1, F.lit(pool)), F.col("r") + F.lit(k) - F.col("g"), F.lit(pool))
    recs = (gaps.filter(hi >= F.col("r") + 1)
            .select("visitorid", "r", "g", F.explode(F.sequence(F.col("r") + 1, hi)).alias("pop_rank"))
            .withColumn("rank", (F.col("g") + F.col("pop_rank") - F.col("r")).cast("int")))
    return _join_pool(recs, ranks, pool, "pop_rank").select("visitorid", "rank", "itemid", "pop_rank")


def popular_precision(train: DataFrame, eval_df: DataFrame, k: int = 10, denominator: str = "list") -> DataFrame:
    """Hits / len(list) (or / k with ``denominator="k"``), mean over eval users with a non-empty list (Q5)."""
    if denominator not in ("list", "k"):
        raise ValueError("denominator must be 'list' or 'k'")
    size = F.col("n_recs") if denominator == "list" else F.lit(k)
    users = eval_df.select("visitorid").filter(F.col("visitorid").isNotNull()).distinct()
    recs = recommend_popular(train, users, k)
    truth = eval_df.select("visitorid", "itemid").distinct().withColumn("_hit", F.lit(1))
    per_user = (recs.join(truth, ["visitorid", "itemid"], "left")
                .groupBy("visitorid")
                .agg(F.count(F.lit(1)).alias("n_recs"), F.count("_hit").alias("hits")))
    return per_user.agg(
        F.count(F.lit(1)).alias("eval_users"),
        F.coalesce(F.sum("hits"), F.lit(0)).cast("long").alias("hits"),
        F.round(F.coalesce(F.avg(F.col("hits") / size), F.lit(0.0)), 6).alias("mean_precision"),
    )
