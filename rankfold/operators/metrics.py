"""Hits, Precision@K and Recall@K over long-form lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_user_hits(recs: DataFrame, truth: DataFrame, k: int, user: str = "visitorid",
                  item: str = "itemid") -> DataFrame:
    """Per user with truth: hits in the first k recs, truth size, list length.

    ``recs``: (user, item, rank); ``truth``: (user, item), deduplicated here.
    Users with truth but no list get n_recs = 0.
    """
    t = truth.select(user, item).distinct()
    t_size = t.groupBy(user).agg(F.count(F.lit(1)).alias("n_truth"))
    top = recs.filter(F.col("rank") <= k).select(user, item)
    hits = (top.join(t.withColumn("_hit", F.lit(1)), [user, item], "left")
            .groupBy(user).agg(F.count(F.lit(1)).alias("n_recs"), F.count("_hit").alias("hits")))
    return (t_size.join(hits, user, "left")
            .select(user, F.coalesce("hits", F.lit(0)).cast("long").alias("hits"),
                    F.col("n_truth").cast("long").alias("n_truth"),
                    F.coalesce("n_recs", F.lit(0)).cast("long").alias("n_recs")))


def safe_ratio(num, den):
    """F8: num / den, 0.0 when den is 0."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def sampling_ratio(sampled, available):
    """sampled users in percent of those available, one decimal; 0.0 when none are."""
    return F.round(safe_ratio(sampled * 100.0, available), 1)


def precision_recall_at_k(recs: DataFrame, truth: DataFrame, k: int, user: str = "visitorid",
                          item: str = "itemid", require_list: bool = False) -> DataFrame:
    """hits/k and hits/|truth| averaged over users with truth.

    ``require_list``: leave users without any recommendation out of the mean
    (the SVD evaluator does that); otherwise they count as 0.
    """
    pu = per_user_hits(recs, truth, k, user, item)
    if require_list:
        pu = pu.filter(F.col("n_recs") > 0)
    return pu.agg(
        F.count(F.lit(1)).alias("users"),
        F.coalesce(F.sum("hits"), F.lit(0)).cast("long").alias("hits"),
        F.round(F.coalesce(F.avg(safe_ratio(F.col("hits"), F.lit(k))), F.lit(0.0)), 6).alias("precision_at_k"),
        F.round(F.coalesce(F.avg(safe_ratio(F.col("hits"), F.col("n_truth"))), F.lit(0.0)), 6).alias("recall_at_k"),
    )


def precision_recall_per_model(recs: DataFrame, truth: DataFrame, k: int, models: list[str], user: str = "visitorid",
                               item: str = "itemid", require_list: bool = False) -> DataFrame:
    """``precision_recall_at_k`` of several models' lists at once: (model, users, hits, precision_at_k, recall_at_k).

    ``recs``: (model, user, item, rank).  Users with truth but no list of a
    model have no row there; they count by the number of users, so no user is
    paired with every model.
    """
    t = truth.select(user, item).distinct()
    t_size = t.groupBy(user).agg(F.count(F.lit(1)).alias("n_truth"))
    top = recs.filter(F.col("rank") <= k).select("model", user, item)
    # only hits are summed, so only they go on from the join
    per = top.join(t, [user, item]).groupBy("model", user).agg(F.count(F.lit(1)).alias("hits")).join(t_size, user)
    sums = per.groupBy("model").agg(
        F.sum("hits").alias("hits"), F.sum(F.col("hits") / F.lit(k)).alias("_p"),
        F.sum(F.col("hits") / F.col("n_truth")).alias("_r"))
    if require_list:
        lists = (top.select("model", user).distinct().join(t_size, user, "left_semi")
                 .groupBy("model").agg(F.count(F.lit(1)).alias("lists")))
        sums = lists.join(sums, "model", "left")
    named = t_size.groupBy().agg(F.count(F.lit(1)).alias("_users")).select(
        F.explode(F.array(*[F.lit(m) for m in models])).alias("model"), "_users")
    users = F.coalesce(F.col("lists"), F.lit(0)) if require_list else F.col("_users")
    mean = lambda x: F.round(safe_ratio(F.coalesce(x, F.lit(0.0)), users), 6)
    return (named.join(sums, "model", "left")
            .select("model", users.cast("long").alias("users"), F.coalesce("hits", F.lit(0)).cast("long").alias("hits"),
                    mean(F.col("_p")).alias("precision_at_k"), mean(F.col("_r")).alias("recall_at_k")))
