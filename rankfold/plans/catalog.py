"""The query catalog: every operator as (spark, sf_dir) -> DataFrame, each next
to its oracle SQL (DuckDB dialect over the driver's tables) where one exists.

Fixture (see FIXTURES.md): the log is lineitem joined to orders; "tune" trains
on Period 1 and evaluates on Period 2, "final" trains on Period 2 and
evaluates on Period 3.  Queries that exist per phase return both phases with a
``phase`` column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import h
from ..operators import dictionary as dic
from ..operators import interactions as inter
from ..operators import popularity as pop
from ..operators import ratings as rat
from ..operators.ranking import global_index
from ..operators.splits import FIXTURE_PERIODS, PHASES, SPLIT_NAMES, PhaseSplits, build_phase, cold, period_bounds, tagged_splits, warm
from ..session import keep, scratch_path
from ..sources.events import tpch_events, tpch_raw_events
from .sqlbase import CLICKS, CLICKS_RAW, EV, both_phases, cells_sql, with_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

K = 10


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def phases(spark: SparkSession, sf: str) -> dict[str, PhaseSplits]:
    # the log is re-planned per branch: each scans only its period and columns
    return {ph: build_phase(tpch_events(spark, sf, period_bounds(ph)), ph) for ph in PHASES}


def stored_phases(spark: SparkSession, sf: str) -> dict[str, PhaseSplits]:
    """``phases`` over a log that is joined once: its four columns written to the shared folder, read by every branch."""
    days = [d for ph in PHASES for d in period_bounds(ph)]
    path = scratch_path(spark, "log")
    tpch_events(spark, sf, (min(days), max(days))).select("visitorid", "itemid", "event", "timestamp").write.parquet(path)
    log = spark.read.parquet(path)
    return {ph: build_phase(log, ph) for ph in PHASES}


def per_phase(spark, sf, fn, splits=phases) -> DataFrame:
    return union_all([fn(sp).select(F.lit(ph).alias("phase"), "*") for ph, sp in splits(spark, sf).items()])


def phase_sql(body_fn, extra_fn=None) -> str:
    return both_phases(lambda ph: f"SELECT '{ph}' AS phase, * FROM ({body_fn(ph)})", extra_fn)


# --------------------------------------------------------------------- sources
@query("src_events", with_sql(
    "SELECT visitorid, itemid, event, timestamp, transactionid, date FROM ev"))
def q_src_events(spark, sf):
    return tpch_events(spark, sf).select("visitorid", "itemid", "event", "timestamp", "transactionid", "date")


@query("events_csv_roundtrip", with_sql("SELECT visitorid, timestamp, event, itemid, transactionid FROM ev"))
def q_events_csv_roundtrip(spark, sf):
    """The log written as CSV with its columns in another order, read back by name."""
    from ..session import scratch_path
    from ..sources.events import read_raw_events
    path = scratch_path(spark, "events-csv")
    (tpch_raw_events(spark, sf).select("timestamp", "transactionid", "itemid", "event", "visitorid")
     .write.option("header", True).csv(path))
    return read_raw_events(spark, path)


@query("time_features", "WITH " + ",\n".join([CLICKS_RAW]) + """
SELECT visitorid, itemid, event, timestamp,
       CAST(to_timestamp(timestamp / 1000.0) AT TIME ZONE 'UTC' AS DATE) AS date,
       CAST(hour(to_timestamp(timestamp / 1000.0) AT TIME ZONE 'UTC') AS INTEGER) AS hour,
       CAST((isodow(to_timestamp(timestamp / 1000.0) AT TIME ZONE 'UTC') - 1) AS INTEGER) AS day_of_week,
       isodow(to_timestamp(timestamp / 1000.0) AT TIME ZONE 'UTC') IN (6, 7) AS is_weekend
FROM clk_raw WHERE event IN ('view', 'addtocart', 'transaction')""")
def q_time_features(spark, sf):
    from ..sources.events import click_events
    return click_events(spark, sf).select("visitorid", "itemid", "event", "timestamp", "date", "hour",
                                          "day_of_week", "is_weekend")


# ---------------------------------------------------------------------- splits
_SPLIT_ATTR = ("train", "eval_warm", "eval_cold", "eval_full")
_SPLIT_CTE = ("tr", "wa", "co", "fu")


@query("split_periods", phase_sql(
    lambda ph: "SELECT split, count(*) AS n_events, min(date) AS first_day, max(date) AS last_day FROM ("
    + f"SELECT '{SPLIT_NAMES[ph][0]}' AS split, date FROM tr UNION ALL "
    + f"SELECT '{SPLIT_NAMES[ph][3]}' AS split, date FROM fu) GROUP BY split"))
def q_split_periods(spark, sf):
    def one(sp: PhaseSplits):
        n = SPLIT_NAMES[sp.phase]
        t = union_all([sp.train.select(F.lit(n[0]).alias("split"), "date"),
                       sp.eval_full.select(F.lit(n[3]).alias("split"), "date")])
        return t.groupBy("split").agg(F.count(F.lit(1)).alias("n_events"), F.min("date").alias("first_day"),
                                      F.max("date").alias("last_day"))
    return per_phase(spark, sf, one)


_ROW_COLS = "visitorid, itemid, event, timestamp"


@query("split_warm", phase_sql(lambda ph: f"SELECT {_ROW_COLS} FROM wa"))
def q_split_warm(spark, sf):
    return per_phase(spark, sf, lambda sp: sp.eval_warm.select("visitorid", "itemid", "event", "timestamp"))


@query("split_cold", phase_sql(lambda ph: f"SELECT {_ROW_COLS} FROM co"))
def q_split_cold(spark, sf):
    return per_phase(spark, sf, lambda sp: sp.eval_cold.select("visitorid", "itemid", "event", "timestamp"))


def _split_summary_sql(ph):
    names = SPLIT_NAMES[ph]
    sel = " UNION ALL ".join(
        f"SELECT '{n}' AS split, visitorid, itemid FROM {c}" for n, c in zip(names, _SPLIT_CTE))
    return (f"SELECT split, count(*) AS events, count(DISTINCT visitorid) AS users, "
            f"count(DISTINCT itemid) AS items FROM ({sel}) GROUP BY split")


@query("split_summary", both_phases(_split_summary_sql))
def q_split_summary(spark, sf):
    """Events, users, items for all eight splits."""
    t = union_all([df.withColumn("split", F.lit(n)) for sp in phases(spark, sf).values()
                   for n, df in sp.named().items()])
    return t.groupBy("split").agg(F.count(F.lit(1)).alias("events"),
                                  F.countDistinct("visitorid").alias("users"),
                                  F.countDistinct("itemid").alias("items"))


@query("split_store_roundtrip", both_phases(_split_summary_sql))
def q_split_store_roundtrip(spark, sf):
    """Write the splits partitioned by name, read back with partition pruning."""
    from ..sources.stores import read_split, write_splits
    path = write_splits(tpch_events(spark, sf))
    names = [n for ph in PHASES for n in SPLIT_NAMES[ph]]
    back = union_all([read_split(spark, path, n).withColumn("split", F.lit(n)) for n in names])
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("events"),
                                     F.countDistinct("visitorid").alias("users"),
                                     F.countDistinct("itemid").alias("items"))


# ---------------------------------------------------------------- dictionaries
@query("id_dictionary", phase_sql(
    lambda ph: "SELECT field, raw, idx FROM (SELECT 'visitorid' AS field, raw, idx FROM du_w "
               "UNION ALL SELECT 'itemid', raw, idx FROM di_w)"))
def q_id_dictionary(spark, sf):
    def one(sp):
        d = dic.phase_dictionaries(sp, "warm")
        return union_all([d[f].select(F.lit(f).alias("field"), "raw", "idx") for f in ("visitorid", "itemid")])
    return per_phase(spark, sf, one)


@query("id_dictionary_full", phase_sql(
    lambda ph: "SELECT field, raw, idx FROM (SELECT 'visitorid' AS field, raw, idx FROM du_f "
               "UNION ALL SELECT 'itemid', raw, idx FROM di_f)"))
def q_id_dictionary_full(spark, sf):
    def one(sp):
        d = dic.phase_dictionaries(sp, "full")
        return union_all([d[f].select(F.lit(f).alias("field"), "raw", "idx") for f in ("visitorid", "itemid")])
    return per_phase(spark, sf, one)


@query("event_codes", phase_sql(lambda ph: "SELECT raw AS event, idx AS code FROM de"))
def q_event_codes(spark, sf):
    return per_phase(spark, sf, lambda sp: dic.event_dictionary(sp.train)
                     .select(F.col("raw").alias("event"), F.col("idx").alias("code")))


@query("encode_ids", phase_sql(
    lambda ph: "SELECT w.visitorid, w.itemid, w.timestamp, u.idx AS user_idx, i.idx AS item_idx "
               "FROM wa w JOIN du_w u ON w.visitorid = u.raw JOIN di_w i ON w.itemid = i.raw"))
def q_encode_ids(spark, sf):
    def one(sp):
        d = dic.phase_dictionaries(sp, "warm")
        x = dic.encode(sp.eval_warm.select("visitorid", "itemid", "timestamp"), d["visitorid"], "visitorid", "user_idx")
        return dic.encode(x, d["itemid"], "itemid", "item_idx")
    return per_phase(spark, sf, one)


@query("decode_ids", phase_sql(
    lambda ph: "SELECT c.user_idx, c.item_idx, u.raw AS visitorid, i.raw AS itemid, c.weight "
               f"FROM ({cells_sql('co', 'full')}) c JOIN du_f u ON c.user_idx = u.idx JOIN di_f i ON c.item_idx = i.idx"))
def q_decode_ids(spark, sf):
    def one(sp):
        mats, d = inter.phase_bundle(sp, "full")
        c = mats["validation_cold" if sp.phase == "tune" else "test_cold"]
        c = dic.decode(c, d["visitorid"], "user_idx", "visitorid")
        return dic.decode(c, d["itemid"], "item_idx", "itemid").select("user_idx", "item_idx", "visitorid", "itemid", "weight")
    return per_phase(spark, sf, one)


@query("dict_store_roundtrip", phase_sql(
    lambda ph: "SELECT scope, field, count(*) AS n, sum(raw) AS raw_sum, sum(idx) AS idx_sum FROM ("
               "SELECT 'warm' AS scope, 'visitorid' AS field, raw, idx FROM du_w UNION ALL "
               "SELECT 'warm', 'itemid', raw, idx FROM di_w UNION ALL "
               "SELECT 'full', 'visitorid', raw, idx FROM du_f UNION ALL "
               "SELECT 'full', 'itemid', raw, idx FROM di_f) GROUP BY scope, field"))
def q_dict_store_roundtrip(spark, sf):
    """Write the dictionaries partitioned by (phase, scope, field), read back."""
    from ..sources.stores import read_dictionary, write_dictionaries
    ps = stored_phases(spark, sf)
    path = write_dictionaries(dic.all_dictionaries(ps))
    parts = []
    for ph in PHASES:
        for sc in ("warm", "full"):
            for f in ("visitorid", "itemid"):
                d = read_dictionary(spark, path, ph, sc, f)
                parts.append(d.select(F.lit(ph).alias("phase"), F.lit(sc).alias("scope"), F.lit(f).alias("field"),
                                      F.col("raw").cast("long").alias("raw"), "idx"))
    return (union_all(parts).groupBy("phase", "scope", "field")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("raw").alias("raw_sum"), F.sum("idx").alias("idx_sum")))


# ----------------------------------------------------------- interaction cells
_MATS = {("tune", "warm"): [("train_val", "tr"), ("validation_warm", "wa")],
         ("tune", "full"): [("train_val", "tr"), ("validation_full", "fu"), ("validation_cold", "co")],
         ("final", "warm"): [("train", "tr"), ("test_warm", "wa")],
         ("final", "full"): [("train", "tr"), ("test_full", "fu"), ("test_cold", "co")]}


def _all_cells_sql(ph):
    sel = []
    for (p, scope), mats in _MATS.items():
        if p != ph:
            continue
        for name, cte in mats:
            sel.append(f"SELECT '{scope}' AS scope, '{name}' AS matrix, * FROM ({cells_sql(cte, scope)})")
    return " UNION ALL ".join(sel)


@query("interaction_matrix", both_phases(
    lambda ph: f"SELECT '{ph}' AS phase, scope, matrix, user_idx, item_idx, weight FROM ({_all_cells_sql(ph)})"))
def q_interaction_matrix(spark, sf):
    """I4 + A9: the ten matrices, long form."""
    return inter.all_interactions(inter.period_sums(tpch_events(spark, sf)))


def _matrix_stats_sql(ph):
    return (f"SELECT '{ph}' AS phase, scope, matrix, "
            "CASE WHEN scope = 'warm' THEN (SELECT count(*) FROM du_w) ELSE (SELECT count(*) FROM du_f) END AS n_users, "
            "CASE WHEN scope = 'warm' THEN (SELECT count(*) FROM di_w) ELSE (SELECT count(*) FROM di_f) END AS n_items, "
            "count(*) AS stored_cells, count(*) FILTER (WHERE weight <> 0) AS nonzero_cells, "
            "count(DISTINCT user_idx) FILTER (WHERE weight <> 0) AS users_with_interactions "
            f"FROM ({_all_cells_sql(ph)}) GROUP BY scope, matrix")


@query("matrix_stats", both_phases(_matrix_stats_sql))
def q_matrix_stats(spark, sf):
    """A10: dictionary sizes, stored and non-zero cells and active users of the ten matrices."""
    sums = inter.period_sums(tpch_events(spark, sf))
    return inter.all_matrix_stats(inter.all_interactions(sums), inter.dictionary_sizes(sums))


@query("matrix_store_roundtrip", both_phases(
    lambda ph: f"SELECT '{ph}' AS phase, scope, matrix, count(*) AS cells, sum(weight) AS weight_sum, "
               f"sum(user_idx) AS user_sum, sum(item_idx) AS item_sum FROM ({_all_cells_sql(ph)}) GROUP BY scope, matrix"))
def q_matrix_store_roundtrip(spark, sf):
    """Write all matrices partitioned by (phase, scope, matrix), read back."""
    from ..sources.stores import read_interactions, write_interactions
    path = write_interactions(inter.all_interactions(inter.period_sums(tpch_events(spark, sf))))
    parts = []
    for (ph, scope), mats in _MATS.items():
        for name, _ in mats:
            c = read_interactions(spark, path, ph, scope, name)
            parts.append(c.select(F.lit(ph).alias("phase"), F.lit(scope).alias("scope"), F.lit(name).alias("matrix"),
                                  "user_idx", "item_idx", "weight"))
    return (union_all(parts).groupBy("phase", "scope", "matrix")
            .agg(F.count(F.lit(1)).alias("cells"), F.sum("weight").alias("weight_sum"),
                 F.sum("user_idx").alias("user_sum"), F.sum("item_idx").alias("item_sum")))


@query("bucketed_decode", phase_sql(
    lambda ph: f"SELECT u.raw AS visitorid, count(*) AS cells, sum(weight) AS weight FROM ({cells_sql('tr', 'warm')}) c "
               "JOIN du_w u ON c.user_idx = u.idx GROUP BY u.raw"))
def q_bucketed_decode(spark, sf):
    """S5 + S6 pre-partitioned: training cells and the visitor dictionary bucketed by index, summed and decoded unshuffled."""
    from ..sources.stores import read_bucketed, write_bucketed

    def one(sp):
        mats, d = inter.phase_bundle(sp, "warm")
        cells = read_bucketed(spark, write_bucketed(mats["train_val" if sp.phase == "tune" else "train"], "user_idx", 8),
                              "user_idx", 8)
        users = read_bucketed(spark, write_bucketed(d["visitorid"], "idx", 8), "idx", 8)
        return stored_sums(cells, users)
    return per_phase(spark, sf, one, stored_phases)


def stored_sums(cells, users) -> DataFrame:
    """(visitorid, cells, weight) of encoded cells and a dictionary; no shuffle if both are bucketed by the index."""
    per = cells.groupBy("user_idx").agg(F.count(F.lit(1)).alias("cells"), F.sum("weight").alias("weight"))
    return per.join(users.hint("merge"), per["user_idx"] == users["idx"]).select(
        F.col("raw").alias("visitorid"), "cells", "weight")


@query("ground_truth_nonzero", phase_sql(
    lambda ph: f"SELECT user_idx, item_idx, weight FROM ({cells_sql('wa', 'warm')}) WHERE weight <> 0"))
def q_ground_truth_nonzero(spark, sf):
    def one(sp):
        mats, _ = inter.phase_bundle(sp, "warm")
        return inter.nonzero(mats["validation_warm" if sp.phase == "tune" else "test_warm"])
    return per_phase(spark, sf, one, stored_phases)


@query("foldin_profile", phase_sql(
    lambda ph: "SELECT user_idx, item_idx, CAST(sum(weight) AS DOUBLE) AS weight FROM ("
               f"{cells_sql('tr', 'warm')} UNION ALL {cells_sql('wa', 'warm')}) GROUP BY 1, 2"))
def q_foldin_profile(spark, sf):
    """Train + eval cells summed (the profile a fold-in starts from)."""
    def one(sp):
        mats, _ = inter.phase_bundle(sp, "warm")
        a, b = list(mats.values())
        return (a.unionByName(b).groupBy("user_idx", "item_idx")
                .agg(F.sum("weight").cast("double").alias("weight")))
    return per_phase(spark, sf, one, stored_phases)


# --------------------------------------------------------------------- ratings
_BASE = "CASE event WHEN 'view' THEN 1 WHEN 'addtocart' THEN 2 WHEN 'transaction' THEN 3 END"


def _h(*parts: str, seed: int = 42) -> str:
    joined = ", ".join(list(parts) + [f"'{seed}'"])
    return f"('0x' || substr(md5(concat_ws('|', {joined})), 1, 15))::BIGINT"


def _ratings_ctes(src: str = "tr") -> list[str]:
    u = f"(({_h('CAST(visitorid AS VARCHAR)', 'CAST(itemid AS VARCHAR)', chr(39) + 'rate' + chr(39))}) % 1000000) / 1000000.0"
    return [
        f"base AS (SELECT visitorid, itemid, max({_BASE}) AS rating FROM {src} GROUP BY 1, 2)",
        f"pur AS (SELECT DISTINCT visitorid, itemid FROM {src} WHERE event = 'transaction')",
        "pr AS (SELECT p.visitorid, p.itemid, "
        + _h("CAST(p.visitorid AS VARCHAR)", "CAST(p.itemid AS VARCHAR)", "'pick'")
        + " AS hp FROM pur p JOIN base b USING (visitorid, itemid))",
        "picked AS (SELECT visitorid, itemid FROM (SELECT *, row_number() OVER (ORDER BY hp, visitorid, itemid) AS rn, "
        "count(*) OVER () AS n FROM pr) WHERE rn <= floor(0.2 * n))",
        f"drawn AS (SELECT visitorid, itemid, {u} AS uu FROM picked)",
        "expl AS (SELECT visitorid, itemid, CASE WHEN uu < 0.2 THEN 1 WHEN uu < 0.4 THEN 2 WHEN uu < 0.6 THEN 3 "
        "WHEN uu < 0.9 THEN 4 ELSE 5 END AS explicit_rating FROM drawn)",
        "hyb AS (SELECT b.visitorid AS user_id, b.itemid AS item_id, "
        "CAST(coalesce(e.explicit_rating, b.rating) AS INTEGER) AS rating FROM base b "
        "LEFT JOIN expl e USING (visitorid, itemid))",
    ]


@query("base_ratings", phase_sql(
    lambda ph: f"SELECT visitorid, itemid, CAST(max({_BASE}) AS INTEGER) AS rating FROM tr GROUP BY 1, 2"))
def q_base_ratings(spark, sf):
    return per_phase(spark, sf, lambda sp: rat.base_ratings(sp.train).withColumn("rating", F.col("rating").cast("int")))


@query("purchases_distinct", phase_sql(
    lambda ph: "SELECT DISTINCT visitorid, itemid FROM tr WHERE event = 'transaction'"))
def q_purchases_distinct(spark, sf):
    return per_phase(spark, sf, lambda sp: rat.purchases(sp.train))


@query("explicit_ratings", phase_sql(lambda ph: "SELECT user_id, item_id, rating FROM hyb",
                                     lambda ph: _ratings_ctes()))
def q_explicit_ratings(spark, sf):
    """G1: hybrid ratings, 20 % of purchased pairs carry a drawn 1-5 rating."""
    return per_phase(spark, sf, lambda sp: rat.hybrid_ratings(sp.train))


@query("rating_stats", phase_sql(
    lambda ph: "SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, "
               "count(*) AS n_ratings, round(coalesce(avg(rating), 0.0), 6) AS global_mean FROM hyb",
    lambda ph: _ratings_ctes()))
def q_rating_stats(spark, sf):
    return per_phase(spark, sf, lambda sp: rat.rating_stats(rat.hybrid_ratings(sp.train))
                     .withColumn("global_mean", F.round("global_mean", 6)))


@query("ratings_csv_roundtrip", phase_sql(lambda ph: "SELECT user_id, item_id, rating FROM hyb",
                                          lambda ph: _ratings_ctes()))
def q_ratings_csv_roundtrip(spark, sf):
    """S2 + S3: header-less rating CSV written and read back with named columns."""
    from ..session import scratch_path
    from ..sources.stores import read_ratings, write_ratings

    def one(sp):
        path = scratch_path(spark, f"ratings-{sp.phase}")
        write_ratings(rat.hybrid_ratings(sp.train), path)
        return read_ratings(spark, path)
    return per_phase(spark, sf, one)


# ------------------------------------------------------------------ popularity
@query("item_popularity", phase_sql(
    lambda ph: "SELECT itemid, count(*) AS cnt FROM tr WHERE itemid IS NOT NULL GROUP BY itemid"))
def q_item_popularity(spark, sf):
    return per_phase(spark, sf, lambda sp: pop.item_popularity(sp.train))


@query("item_weight_popularity", phase_sql(
    lambda ph: f"SELECT item_idx, CAST(sum(weight) AS DOUBLE) AS cnt FROM ({cells_sql('tr', 'full')}) GROUP BY item_idx"))
def q_item_weight_popularity(spark, sf):
    def one(sp):
        mats, _ = inter.phase_bundle(sp, "full")
        return pop.item_popularity(mats["train_val" if sp.phase == "tune" else "train"], "item_idx", by="weight")
    return per_phase(spark, sf, one)


@query("item_rating_popularity", phase_sql(
    lambda ph: "SELECT item_id, count(*) AS cnt FROM hyb GROUP BY item_id", lambda ph: _ratings_ctes()))
def q_item_rating_popularity(spark, sf):
    return per_phase(spark, sf, lambda sp: pop.item_popularity(rat.hybrid_ratings(sp.train), "item_id"))


@query("most_active_user", phase_sql(
    lambda ph: "SELECT max(n) AS max_events, arg_min(visitorid, (-n, visitorid)) AS visitorid "
               "FROM (SELECT visitorid, count(*) AS n FROM tr GROUP BY visitorid)"))
def q_most_active_user(spark, sf):
    return per_phase(spark, sf, lambda sp: pop.most_active_user(sp.train))


_POOL_CTES = [
    "ip AS (SELECT itemid, count(*) AS cnt FROM tr GROUP BY itemid)",
    "rk AS (SELECT itemid, cnt, row_number() OVER (ORDER BY cnt DESC, itemid) AS pop_rank FROM ip)",
    f"pool AS (SELECT (SELECT max(n) FROM (SELECT count(*) AS n FROM tr GROUP BY visitorid)) + {K} AS n)",
]


@query("popular_pool", phase_sql(
    lambda ph: "SELECT itemid, cnt, pop_rank FROM rk WHERE pop_rank <= (SELECT n FROM pool)",
    lambda ph: _POOL_CTES))
def q_popular_pool(spark, sf):
    """The top max_user_events + k items of the training period."""
    def one(sp):
        ranks = pop.popularity_ranks(pop.item_popularity(sp.train))
        pool = (pop.user_activity(sp.train).agg(F.max("n_events")).first()[0] or 0) + K
        return ranks.filter(F.col("pop_rank") <= pool).select("itemid", "cnt", "pop_rank")
    return per_phase(spark, sf, one)


_POPULAR_TOPK_CTES = _POOL_CTES + [
    "us AS (SELECT DISTINCT visitorid FROM fu)",
    "seen AS (SELECT DISTINCT visitorid, itemid FROM tr)",
    "cand AS (SELECT us.visitorid, rk.itemid, rk.pop_rank FROM us, rk WHERE rk.pop_rank <= (SELECT n FROM pool))",
    "unseen AS (SELECT c.* FROM cand c WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.visitorid = c.visitorid "
    "AND s.itemid = c.itemid))",
    f"recs AS (SELECT * FROM (SELECT visitorid, itemid, pop_rank, row_number() OVER (PARTITION BY visitorid "
    f"ORDER BY pop_rank) AS rank FROM unseen) WHERE rank <= {K})",
]


@query("popular_topk", phase_sql(
    lambda ph: "SELECT visitorid, CAST(rank AS INTEGER) AS rank, itemid, pop_rank FROM recs",
    lambda ph: _POPULAR_TOPK_CTES))
def q_popular_topk(spark, sf):
    """R1 (+ W1, J6): top-k unseen popular items per eval user."""
    return per_phase(spark, sf, lambda sp: pop.recommend_popular(sp.train, sp.eval_full.select("visitorid"), K))


@query("popular_precision", phase_sql(
    lambda ph: "SELECT count(*) AS eval_users, CAST(coalesce(sum(hits), 0) AS BIGINT) AS hits, "
               "round(coalesce(avg(hits / n_recs), 0.0), 6) AS mean_precision FROM ("
               "SELECT r.visitorid, count(*) AS n_recs, count(t.itemid) AS hits FROM recs r "
               "LEFT JOIN (SELECT DISTINCT visitorid, itemid FROM fu) t USING (visitorid, itemid) "
               "GROUP BY r.visitorid)",
    lambda ph: _POPULAR_TOPK_CTES))
def q_popular_precision(spark, sf):
    """The minimum slice: log -> splits -> popularity top-10 -> precision."""
    return per_phase(spark, sf, lambda sp: pop.popular_precision(sp.train, sp.eval_full, K))


# ------------------------------------------------------------------- profiling
from ..operators import profile as prof  # noqa: E402
from ..functions.timefeat import with_time_features  # noqa: E402
from ..sources.events import click_raw_events  # noqa: E402

_RAW = "raw AS (SELECT visitorid, timestamp, event, itemid, transactionid FROM ev)"


@query("profile_shape", with_sql(
    "SELECT position, column_name, data_type, (SELECT count(*) FROM raw) AS n_rows, 5 AS n_columns FROM (VALUES "
    "(0, 'visitorid', 'bigint'), (1, 'timestamp', 'bigint'), (2, 'event', 'string'), (3, 'itemid', 'bigint'), "
    "(4, 'transactionid', 'bigint')) t(position, column_name, data_type)", extra=[_RAW]))
def q_profile_shape(spark, sf):
    return prof.shape(tpch_raw_events(spark, sf))


@query("profile_nulls", with_sql(
    "SELECT column_name, n_null FROM (SELECT count(*) FILTER (WHERE visitorid IS NULL) AS visitorid, "
    "count(*) FILTER (WHERE timestamp IS NULL) AS timestamp, count(*) FILTER (WHERE event IS NULL) AS event, "
    "count(*) FILTER (WHERE itemid IS NULL) AS itemid, count(*) FILTER (WHERE transactionid IS NULL) AS transactionid "
    "FROM raw) UNPIVOT (n_null FOR column_name IN (visitorid, timestamp, event, itemid, transactionid))",
    extra=[_RAW]))
def q_profile_nulls(spark, sf):
    return prof.null_counts(tpch_raw_events(spark, sf))


@query("event_counts", "WITH " + CLICKS_RAW + """
SELECT event, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct,
       event IN ('view', 'addtocart', 'transaction') AS known
FROM clk_raw WHERE event IS NOT NULL GROUP BY event""")
def q_event_counts(spark, sf):
    """A3 on the click fixture (which also carries unknown labels)."""
    return prof.event_counts(click_raw_events(spark, sf))


@query("profile_duplicates", with_sql(
    "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows, count(*) FILTER (WHERE n > 1) AS duplicated_keys "
    "FROM (SELECT count(*) AS n FROM raw GROUP BY ALL_COLS)".replace(
        "ALL_COLS", "visitorid, timestamp, event, itemid, transactionid"), extra=[_RAW]))
def q_profile_duplicates(spark, sf):
    return prof.duplicate_rows(tpch_raw_events(spark, sf))


@query("distinct_counts", with_sql(
    "SELECT count(DISTINCT visitorid) AS n_visitors, count(DISTINCT itemid) AS n_items, count(*) AS n_events FROM ev"))
def q_distinct_counts(spark, sf):
    return prof.distinct_counts(tpch_raw_events(spark, sf))


@query("daily_event_counts", "WITH " + CLICKS_RAW + """
SELECT CAST(to_timestamp(timestamp / 1000.0) AT TIME ZONE 'UTC' AS DATE) AS date, event, count(*) AS count
FROM clk_raw WHERE event IS NOT NULL GROUP BY 1, 2""")
def q_daily_event_counts(spark, sf):
    return prof.daily_event_counts(with_time_features(click_raw_events(spark, sf)))


@query("top_items_per_event", with_sql(
    "SELECT event, itemid, count, rank FROM (SELECT event, itemid, count(*) AS count, row_number() OVER "
    "(PARTITION BY event ORDER BY count(*) DESC, itemid) AS rank FROM ev GROUP BY event, itemid) WHERE rank <= 5"))
def q_top_items_per_event(spark, sf):
    return prof.top_items_per_event(tpch_raw_events(spark, sf), n=5).withColumn("rank", F.col("rank").cast("long"))


@query("top_items_head", with_sql(
    "SELECT event, itemid, count(*) AS count FROM ev GROUP BY event, itemid "
    "ORDER BY event, count DESC, itemid LIMIT 10"))
def q_top_items_head(spark, sf):
    return prof.top_items_head(tpch_raw_events(spark, sf), 10)


@query("events_head", with_sql(
    "SELECT visitorid, timestamp, event, itemid, transactionid FROM raw "
    "ORDER BY timestamp, visitorid, itemid, event LIMIT 5", extra=[_RAW]))
def q_events_head(spark, sf):
    return prof.preview(tpch_raw_events(spark, sf), 5)


@query("profile_summary", with_sql(
    "SELECT * FROM (SELECT count(*) AS n_events, count(DISTINCT visitorid) AS n_visitors, "
    "count(DISTINCT itemid) AS n_items, "
    "round(avg(CASE WHEN event = 'view' THEN 1.0 ELSE 0.0 END) * 100, 6) AS view_pct, "
    "round(avg(CASE WHEN event = 'addtocart' THEN 1.0 ELSE 0.0 END) * 100, 6) AS addtocart_pct, "
    "round(avg(CASE WHEN event = 'transaction' THEN 1.0 ELSE 0.0 END) * 100, 6) AS transaction_pct, "
    "count(*) FILTER (WHERE event IS NULL OR event NOT IN ('view', 'addtocart', 'transaction')) AS unknown_events, "
    "count(*) FILTER (WHERE transactionid IS NULL) AS null_transactionid FROM raw), "
    "(SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM raw "
    "GROUP BY visitorid, timestamp, event, itemid, transactionid)), "
    "(SELECT arg_min(itemid, (-n, itemid)) AS top_item FROM (SELECT itemid, count(*) AS n FROM raw "
    "WHERE event IN ('addtocart', 'transaction') GROUP BY itemid))", extra=[_RAW]))
def q_profile_summary(spark, sf):
    return prof.profile_summary(tpch_raw_events(spark, sf))


# ----------------------------------------------------- serving (frozen factors)
from ..operators import ensemble as ens  # noqa: E402
from ..operators import metrics as met  # noqa: E402
from ..operators import serving as serve  # noqa: E402
from ..operators.factors import FROZEN_KIND, FactorBlocks, frozen_model, predict_pairs  # noqa: E402
from .sqlbase import frozen_sql, score_sql  # noqa: E402


class Serving:
    """Final-phase serving context, built lazily per model."""

    # Small tables that many later jobs of one query read (user / item sets, seen
    # pairs, truth pairs, factor tables) are persisted once instead of being
    # recomputed from the log by every job; the next query releases them.

    def __init__(self, spark, sf, phase: str = "final"):
        self.sf = sf
        # three columns of the phase's two periods, read by every model of the query: kept until the next query
        sp = phases(spark, sf)[phase]
        train, full = (keep(df.select("visitorid", "itemid", "event")) for df in (sp.train, sp.eval_full))
        self.sp = PhaseSplits(phase, train, full, keep(warm(full, train)), cold(full, train))
        self._ratings = None
        self._uni: dict = {}
        self._model: dict = {}
        self._truth: dict = {}
        self.requested = keep(self.sp.eval_full.select("visitorid").distinct())

    @property
    def ratings(self):
        if self._ratings is None:
            self._ratings = keep(rat.hybrid_ratings(self.sp.train))
        return self._ratings

    def uni(self, m):
        scope = serve.SCOPE[m]                       # models of one scope know the same users, items and seen pairs
        if scope not in self._uni:
            u = serve.universe(self.sp, m, self.ratings if m == "svd" else None)
            seen = self.uni("als").seen if scope == "full" else keep(u.seen)         # the same pairs
            self._uni[scope] = serve.Universe(keep(u.users), keep(u.items), seen)
        return self._uni[scope]

    def model(self, m):
        if m not in self._model:
            u = self.uni(m)
            fm = frozen_model(m, u.users.select(F.col("visitorid").alias("raw")),
                              u.items.select(F.col("itemid").alias("raw")))
            fm.user_factors, fm.item_factors = keep(fm.user_factors), keep(fm.item_factors)
            self._model[m] = fm
        return self._model[m]

    def recs(self, m, requested=None, k=K, candidates=None):
        return serve.recommend(self.model(m), self.uni(m), self.requested if requested is None else requested,
                               k, candidates)

    def recs_many(self, names, requested=None, k=K):
        """{model: its lists}; models of one scope are scored by one job."""
        out = {}
        for scope in dict.fromkeys(serve.SCOPE[m] for m in names):
            own = [m for m in names if serve.SCOPE[m] == scope]
            lists = serve.recommend_many({m: self.model(m) for m in own}, self.uni(own[0]),
                                         self.requested if requested is None else requested, k)
            out |= {m: lists.filter(F.col("model") == m).drop("model") for m in own}
        return out

    def all_recs(self, requested=None, k=K):
        return serve.all_recommendations(self.recs_many(serve.MODELS, requested, k))

    def truth(self, scope):
        """Non-zero evaluation cells (raw ids) of the warm or the full split."""
        if scope not in self._truth:
            split = self.sp.eval_warm if scope == "warm" else self.sp.eval_full
            self._truth[scope] = keep(self._nonzero_cells(split))
        return self._truth[scope]

    def _nonzero_cells(self, split):
        # eval cells coded with the training event dictionary, non-zero only
        codes = dic.event_dictionary(self.sp.train).select(F.col("raw").alias("event"),
                                                                       F.col("idx").cast("double").alias("w"))
        return (split.select("visitorid", "itemid", "event").join(F.broadcast(codes), "event")
                .groupBy("visitorid", "itemid").agg(F.sum("w").alias("weight"))
                .filter(F.col("weight") != 0).select("visitorid", "itemid"))


_NZ_SEEN = ("SELECT visitorid, itemid FROM tr JOIN de ON tr.event = de.raw "
            "GROUP BY visitorid, itemid HAVING sum(de.idx) <> 0")
_UNI_SQL = {
    "als": ("SELECT DISTINCT visitorid FROM tr", "SELECT DISTINCT itemid FROM tr", _NZ_SEEN),
    "bpr": ("SELECT DISTINCT visitorid FROM tr", "SELECT DISTINCT itemid FROM tr", _NZ_SEEN),
    "lightfm": ("SELECT visitorid FROM tr UNION SELECT visitorid FROM fu",
                "SELECT itemid FROM tr UNION SELECT itemid FROM fu", _NZ_SEEN),
    "svd": ("SELECT DISTINCT user_id FROM hyb", "SELECT DISTINCT item_id FROM hyb",
            "SELECT user_id AS visitorid, item_id AS itemid FROM hyb"),
}
_TRUTH_SQL = ("truth_{s} AS (SELECT visitorid, itemid FROM {c} JOIN de ON {c}.event = de.raw "
              "GROUP BY visitorid, itemid HAVING sum(de.idx) <> 0)")


def _model_ctes(name: str, req: str = "req", k: int = K, cand: str | None = None) -> list[str]:
    m = name.split("_")[0]                      # als_32: the als universe with frozen factors of another tag
    users, items, seen = _UNI_SQL[m]
    sc = score_sql(FROZEN_KIND[m])
    m = name
    cf = f" AND i.id IN (SELECT itemid FROM {cand})" if cand else ""
    return [
        frozen_sql(f"uf_{m}", m, "user", users),
        frozen_sql(f"if_{m}", m, "item", items),
        f"seen_{m} AS ({seen})",
        f"recs_{m} AS (SELECT * FROM (SELECT u.id AS visitorid, i.id AS itemid, {sc} AS score, "
        f"row_number() OVER (PARTITION BY u.id ORDER BY {sc} DESC, i.id) AS rank "
        f"FROM uf_{m} u JOIN if_{m} i ON TRUE WHERE u.id IN (SELECT visitorid FROM {req}){cf} "
        f"AND NOT EXISTS (SELECT 1 FROM seen_{m} s WHERE s.visitorid = u.id AND s.itemid = i.id)) "
        f"WHERE rank <= {k})",
    ]


def _serving_ctes(models=("als",), req: str = "SELECT DISTINCT visitorid FROM fu",
                  k: int = K, cand: list[str] | None = None, cand_models=()) -> list[str]:
    extra = list(_ratings_ctes()) + [_TRUTH_SQL.format(s="warm", c="wa"), _TRUTH_SQL.format(s="full", c="fu")]
    extra += [f"req AS ({req})"] + (cand or [])
    for m in models:
        extra += _model_ctes(m, "req", k, "cand" if m in cand_models else None)
    return extra


def serving_sql(body: str, models=("als",), req: str = "SELECT DISTINCT visitorid FROM fu",
                k: int = K, cand: list[str] | None = None, cand_models=()) -> str:
    return with_sql(body, "final", _serving_ctes(models, req, k, cand, cand_models))


_ALL = ("als", "bpr", "lightfm", "svd")
_ALL_RECS = " UNION ALL ".join(f"SELECT '{m}' AS model, visitorid, rank, itemid FROM recs_{m}" for m in _ALL)


@query("score_topk", serving_sql("SELECT visitorid, CAST(rank AS INTEGER) AS rank, itemid, score FROM recs_als",
                                 req="SELECT DISTINCT visitorid FROM tr"))
def q_score_topk(spark, sf):
    """ALS-layout scores, top-10 unseen for every training user."""
    s = Serving(spark, sf)
    return s.recs("als", requested=s.sp.train.select("visitorid"))


@query("topk_by_score", serving_sql(
    "SELECT visitorid, CAST(rank AS INTEGER) AS rank, itemid, score FROM recs_svd", ("svd",),
    req="SELECT DISTINCT visitorid FROM tr", k=3))
def q_topk_by_score(spark, sf):
    """W2 with many ties: clipped SVD-layout scores, top 3 for every training visitor."""
    s = Serving(spark, sf)
    return s.recs("svd", requested=s.sp.train.select("visitorid"), k=3)


@query("recs_mf_topn", serving_sql(
    "SELECT 'als' AS model, visitorid, CAST(rank AS INTEGER) AS rank, itemid, score FROM recs_als UNION ALL "
    "SELECT 'bpr', visitorid, CAST(rank AS INTEGER), itemid, score FROM recs_bpr", ("als", "bpr")))
def q_recs_mf_topn(spark, sf):
    """R2: ALS / BPR lists for the requested visitors (unknown ones get none)."""
    s = Serving(spark, sf)
    return union_all([recs.select(F.lit(m).alias("model"), "visitorid", "rank", "itemid", "score")
                      for m, recs in s.recs_many(("als", "bpr")).items()])


@query("recs_hybrid_topn", serving_sql(
    "SELECT visitorid, CAST(rank AS INTEGER) AS rank, itemid, score FROM recs_lightfm", ("lightfm",)))
def q_recs_hybrid_topn(spark, sf):
    """Hybrid lists; every visitor in the full dictionary, cold ones included."""
    return Serving(spark, sf).recs("lightfm")


@query("recs_svd_topn", serving_sql(
    "SELECT visitorid, CAST(rank AS INTEGER) AS rank, itemid, score FROM recs_svd", ("svd",)))
def q_recs_svd_topn(spark, sf):
    """SVD lists over all rated items minus the visitor's rated items."""
    return Serving(spark, sf).recs("svd")


@query("recs_batch", serving_sql(
    "SELECT r.visitorid, CAST(count(a.itemid) AS BIGINT) AS n_items, "
    "coalesce(string_agg(CAST(a.itemid AS VARCHAR), ',' ORDER BY a.rank), '') AS items "
    "FROM req r LEFT JOIN recs_als a USING (visitorid) GROUP BY r.visitorid"))
def q_recs_batch(spark, sf):
    """Requested visitors -> list (empty for unknown visitors)."""
    s = Serving(spark, sf)
    return serve.recommend_batch(s.recs("als"), s.requested)


@query("recs_all_models", serving_sql(
    f"SELECT model, visitorid, CAST(rank AS INTEGER) AS rank, itemid FROM ({_ALL_RECS})", _ALL))
def q_recs_all_models(spark, sf):
    """All four models' lists for the requested visitors."""
    return Serving(spark, sf).all_recs()


@query("known_visitors", serving_sql(
    "SELECT r.visitorid, d.idx AS user_idx, d.idx IS NOT NULL AS known FROM req r LEFT JOIN du_w d "
    "ON r.visitorid = d.raw", ()))
def q_known_visitors(spark, sf):
    """Requested LEFT JOIN the warm user dictionary."""
    s = Serving(spark, sf)
    d = dic.fit_dictionary(s.sp.train, col="visitorid")
    return (dic.to_inner(s.requested, d, "visitorid", "user_idx")
            .select("visitorid", "user_idx", F.col("found").alias("known")))


@query("recs_valid_items", serving_sql(
    "SELECT a.visitorid, CAST(a.rank AS INTEGER) AS rank, a.itemid, d.idx AS item_idx FROM recs_als a "
    "JOIN (SELECT raw, row_number() OVER (ORDER BY raw) - 1 AS idx FROM (SELECT DISTINCT itemid AS raw FROM tr "
    "WHERE event = 'transaction')) d ON a.itemid = d.raw"))
def q_recs_valid_items(spark, sf):
    """P8 + J4: lists checked against the dictionary of purchased items, with the dense index."""
    s = Serving(spark, sf)
    d = dic.fit_dictionary(s.sp.train.filter(F.col("event") == "transaction"), col="itemid")
    recs = serve.valid_items(s.recs("als"), d)
    return dic.to_inner(recs, d, "itemid", "item_idx").select("visitorid", "rank", "itemid", "item_idx")


@query("svd_predict", serving_sql(
    "SELECT p.visitorid, p.itemid, CASE WHEN u.id IS NULL OR i.id IS NULL THEN 3.0 ELSE "
    + score_sql("svd") + " END AS est, (u.id IS NULL OR i.id IS NULL) AS was_impossible "
    "FROM (SELECT DISTINCT visitorid, itemid FROM fu) p LEFT JOIN uf_svd u ON p.visitorid = u.id "
    "LEFT JOIN if_svd i ON p.itemid = i.id", ("svd",)))
def q_svd_predict(spark, sf):
    """M5: clipped SVD estimate per evaluation pair; unknown -> global mean, was_impossible."""
    s = Serving(spark, sf)
    return predict_pairs(s.model("svd"), s.sp.eval_full.select("visitorid", "itemid").distinct())


@query("hybrid_predict", serving_sql(
    "SELECT p.visitorid, p.itemid, CASE WHEN u.id IS NULL OR i.id IS NULL THEN 0.0 ELSE "
    + score_sql("biased") + " END AS est, (u.id IS NULL OR i.id IS NULL) AS was_impossible "
    "FROM (SELECT DISTINCT visitorid, itemid FROM fu) p LEFT JOIN uf_lightfm u ON p.visitorid = u.id "
    "LEFT JOIN if_lightfm i ON p.itemid = i.id", ("lightfm",)))
def q_hybrid_predict(spark, sf):
    """M6: p.q + bu + bi per evaluation pair."""
    s = Serving(spark, sf)
    return predict_pairs(s.model("lightfm"), s.sp.eval_full.select("visitorid", "itemid").distinct())


# ------------------------------------------------------- metrics and fusion
_U3 = "u3 AS (SELECT visitorid, itemid FROM truth_warm UNION SELECT visitorid, itemid FROM truth_full)"
_U3_USERS = "SELECT DISTINCT visitorid FROM (SELECT visitorid FROM truth_warm UNION SELECT visitorid FROM truth_full)"
_ALLRECS = f"allrecs AS ({_ALL_RECS})"
_FUSED = [
    _ALLRECS,
    "pts AS (SELECT visitorid, itemid, CAST(sum(mx - rank + 1) AS BIGINT) AS points FROM "
    "(SELECT *, max(rank) OVER (PARTITION BY visitorid) AS mx FROM allrecs) GROUP BY visitorid, itemid)",
    "fused AS (SELECT *, CAST(row_number() OVER (PARTITION BY visitorid ORDER BY points DESC, itemid) AS INTEGER) "
    "AS fused_rank FROM pts)",
]


def _ens_sql(body, extra, req, phase="final"):
    extra_ctes = list(_ratings_ctes()) + [_TRUTH_SQL.format(s="warm", c="wa"), _TRUTH_SQL.format(s="full", c="fu"), _U3]
    extra_ctes += [f"req AS ({req})"]
    for m in _ALL:
        extra_ctes += _model_ctes(m, "req", K)
    extra_ctes += _FUSED + (extra or [])
    return with_sql(body, phase, extra_ctes)


def _u3(s: Serving):
    # read by several branches of every fusion query: written once, lineage cut
    if "u3" not in s._truth:
        s._truth["u3"] = ens.ground_truth(s.truth("warm"), s.truth("full")).checkpoint(eager=True)
    return s._truth["u3"]


@query("ground_truth", serving_sql("SELECT visitorid, itemid FROM truth_warm UNION SELECT visitorid, itemid FROM truth_full", ()))
def q_ground_truth(spark, sf):
    """Warm U full evaluation items per visitor."""
    return _u3(Serving(spark, sf))


@query("eval_user_index", serving_sql(
    "SELECT coalesce(w.visitorid, f.visitorid) AS visitorid, w.idx AS warm_index, f.idx AS full_index, "
    "w.idx IS NOT NULL AS has_warm, f.idx IS NOT NULL AS has_full FROM "
    "(SELECT d.raw AS visitorid, d.idx FROM du_w d WHERE d.raw IN (SELECT visitorid FROM truth_warm)) w FULL OUTER JOIN "
    "(SELECT d.raw AS visitorid, d.idx FROM du_f d WHERE d.raw IN (SELECT visitorid FROM truth_full)) f "
    "ON w.visitorid = f.visitorid", ()))
def q_eval_user_index(spark, sf):
    """Evaluation users of the warm and the full matrices, aligned by visitor."""
    s = Serving(spark, sf)
    dw = dic.phase_dictionaries(s.sp, "warm")["visitorid"]
    df = dic.phase_dictionaries(s.sp, "full")["visitorid"]
    w = dw.join(s.truth("warm").select(F.col("visitorid").alias("raw")).distinct(), "raw", "left_semi") \
        .select(F.col("raw").alias("visitorid"), "idx")
    f = df.join(s.truth("full").select(F.col("visitorid").alias("raw")).distinct(), "raw", "left_semi") \
        .select(F.col("raw").alias("visitorid"), "idx")
    return ens.eval_user_index(w, f)


@query("hits_per_user", serving_sql(
    "SELECT t.visitorid, CAST(count(r.itemid) AS BIGINT) AS hits, CAST(count(DISTINCT t.itemid) AS BIGINT) AS n_truth, "
    "CAST((SELECT count(*) FROM recs_als x WHERE x.visitorid = t.visitorid) AS BIGINT) AS n_recs "
    "FROM truth_warm t LEFT JOIN recs_als r ON r.visitorid = t.visitorid AND r.itemid = t.itemid "
    "GROUP BY t.visitorid", req="SELECT DISTINCT visitorid FROM truth_warm"))
def q_hits_per_user(spark, sf):
    """Hits of the ALS list against the warm truth, per evaluation user."""
    s = Serving(spark, sf)
    t = s.truth("warm")
    return met.per_user_hits(s.recs("als", requested=t.select("visitorid")), t, K)


def _pr_sql(model, truth, require_list=False):
    having = " WHERE n_recs > 0" if require_list else ""
    return (f"SELECT '{model}' AS model, count(*) AS users, CAST(coalesce(sum(hits), 0) AS BIGINT) AS hits, "
            f"round(coalesce(avg(hits / {K}.0), 0.0), 6) AS precision_at_k, "
            "round(coalesce(avg(hits / n_truth), 0.0), 6) AS recall_at_k FROM ("
            "SELECT t.visitorid, count(r.itemid) AS hits, count(*) AS n_truth, "
            f"(SELECT count(*) FROM recs_{model} x WHERE x.visitorid = t.visitorid) AS n_recs "
            f"FROM {truth} t LEFT JOIN recs_{model} r ON r.visitorid = t.visitorid AND r.itemid = t.itemid "
            f"GROUP BY t.visitorid){having}")


@query("precision_recall_mf", serving_sql(
    _pr_sql("als", "truth_warm") + " UNION ALL " + _pr_sql("bpr", "truth_warm"), ("als", "bpr"),
    req="SELECT DISTINCT visitorid FROM truth_warm"))
def q_precision_recall_mf(spark, sf):
    """Precision@10 / Recall@10 of ALS and BPR on the warm evaluation cells."""
    s = Serving(spark, sf)
    t = s.truth("warm")
    return union_all([met.precision_recall_at_k(recs, t, K).select(F.lit(m).alias("model"), "*")
                      for m, recs in s.recs_many(("als", "bpr"), t.select("visitorid")).items()])


_CAND_HYB = [
    "ipop AS (SELECT itemid, CAST(sum(de.idx) AS DOUBLE) AS cnt FROM tr JOIN de ON tr.event = de.raw GROUP BY itemid)",
    "candall AS (SELECT itemid, max(is_eval) AS is_eval FROM ("
    "SELECT itemid, 0 AS is_eval FROM (SELECT itemid FROM ipop) "
    "UNION ALL SELECT DISTINCT itemid, 1 FROM truth_full) GROUP BY itemid)",
    "cand AS (SELECT c.itemid, c.is_eval, coalesce(p.cnt, 0.0) AS cnt FROM candall c LEFT JOIN ipop p USING (itemid))",
]


def _hybrid_candidates(s: Serving):
    popw = inter.raw_cells(s.sp.train).groupBy("itemid").agg(F.sum("weight").cast("double").alias("cnt"))
    return serve.candidate_items(s.truth("full").select("itemid"), popw)


@query("candidate_items", serving_sql("SELECT itemid, is_eval, cnt FROM cand", (), cand=_CAND_HYB))
def q_candidate_items(spark, sf):
    """Evaluation items U the items with training weight, with no limit."""
    return _hybrid_candidates(Serving(spark, sf))


@query("candidate_reduction", serving_sql(
    "SELECT (SELECT count(*) FROM di_f) AS n_all_items, (SELECT count(*) FROM cand) AS n_candidates, "
    "round(CAST((SELECT count(*) FROM di_f) AS DOUBLE) / (SELECT count(*) FROM cand), 6) AS reduction", (),
    cand=_CAND_HYB))
def q_candidate_reduction(spark, sf):
    """all items / candidate items."""
    s = Serving(spark, sf)
    n_all = s.uni("lightfm").items.agg(F.count(F.lit(1)).alias("n_all_items"))
    n_c = _hybrid_candidates(s).agg(F.count(F.lit(1)).alias("n_candidates"))
    return (inter.one_row([n_all, n_c])
            .withColumn("reduction", F.round(F.col("n_all_items") / F.col("n_candidates"), 6)))


@query("precision_recall_hybrid", serving_sql(
    _pr_sql("lightfm", "truth_full"), ("lightfm",), req="SELECT DISTINCT visitorid FROM truth_full",
    cand=_CAND_HYB, cand_models=("lightfm",)))
def q_precision_recall_hybrid(spark, sf):
    """Hybrid model over the pruned candidate items, full evaluation cells."""
    s = Serving(spark, sf)
    t = s.truth("full")
    recs = s.recs("lightfm", requested=t.select("visitorid"), candidates=_hybrid_candidates(s))
    return met.precision_recall_at_k(recs, t, K).select(F.lit("lightfm").alias("model"), "*")


_CAND_SVD = [
    "rpop AS (SELECT item_id AS itemid, count(*) AS cnt FROM hyb GROUP BY item_id)",
    "cand AS (SELECT itemid FROM (SELECT itemid FROM rpop) "
    "UNION SELECT DISTINCT itemid FROM truth_full)",
]


@query("precision_recall_svd", serving_sql(
    _pr_sql("svd", "truth_full", require_list=True), ("svd",), req="SELECT DISTINCT visitorid FROM truth_full",
    cand=_CAND_SVD, cand_models=("svd",)))
def q_precision_recall_svd(spark, sf):
    """SVD over eval items U top-rated-count items; users without a list left out."""
    return _evaluate_svd(Serving(spark, sf))


def _evaluate_svd(s: Serving, max_users: int | None = None, seed: int = 42) -> DataFrame:
    """E3 over all users with truth, or over a seeded sample of ``max_users`` of them."""
    t = s.truth("full")
    rpop = pop.item_popularity(s.ratings.select(F.col("item_id").alias("itemid")))
    cand = serve.candidate_items(t.select("itemid"), rpop)
    if max_users is not None:
        t = t.join(serve.sample_users(t, max_users, seed), "visitorid", "left_semi")
    recs = s.recs("svd", requested=t.select("visitorid"), candidates=cand)
    return met.precision_recall_at_k(recs, t, K, require_list=True).select(F.lit("svd").alias("model"), "*")


@query("precision_recall_svd_sampled", serving_sql(
    "SELECT p.*, round(least(100, a.n) * 100.0 / a.n, 1) AS sampling_ratio_pct FROM ("
    + _pr_sql("svd", "truth_smp", require_list=True) + ") p, (SELECT count(DISTINCT visitorid) AS n FROM truth_full) a",
    ("svd",), req="SELECT DISTINCT visitorid FROM truth_full", cand=_CAND_SVD + [
        "smp AS (SELECT visitorid FROM (SELECT DISTINCT visitorid FROM truth_full) ORDER BY "
        "('0x' || substr(md5(concat_ws('|', CAST(visitorid AS VARCHAR), '42')), 1, 15))::BIGINT, visitorid LIMIT 100)",
        "truth_smp AS (SELECT * FROM truth_full WHERE visitorid IN (SELECT visitorid FROM smp))"], cand_models=("svd",)))
def q_precision_recall_svd_sampled(spark, sf):
    """E3 + F10: SVD evaluated on a seeded sample of 100 users, with the sampling ratio in percent."""
    s = Serving(spark, sf)
    users = s.truth("full").agg(F.countDistinct("visitorid").alias("_n"))
    return (inter.one_row([_evaluate_svd(s, 100).drop("model"), users])
            .select(F.lit("svd").alias("model"), "users", "hits", "precision_at_k", "recall_at_k",
                    met.sampling_ratio(F.least(F.lit(100), F.col("_n")), F.col("_n")).alias("sampling_ratio_pct")))


@query("sample_users", serving_sql(
    "SELECT visitorid FROM (SELECT DISTINCT visitorid FROM truth_full) ORDER BY "
    + "('0x' || substr(md5(concat_ws('|', CAST(visitorid AS VARCHAR), '42')), 1, 15))::BIGINT, visitorid LIMIT 100", ()))
def q_sample_users(spark, sf):
    """T5: a seeded sample of exactly 100 evaluation users."""
    return serve.sample_users(Serving(spark, sf).truth("full"), 100, seed=42)


_PU = ("SELECT model, visitorid, CAST(count(t.itemid) AS BIGINT) AS hits, "
       "round(CASE WHEN {k} > 0 THEN count(t.itemid) / {k}.0 ELSE 0.0 END, 6) AS precision "
       "FROM (SELECT * FROM allrecs WHERE rank <= {k}) l LEFT JOIN u3 t USING (visitorid, itemid) GROUP BY model, visitorid")


@query("precision_per_user", _ens_sql(_PU.format(k=K), None, _U3_USERS))
def q_precision_per_user(spark, sf):
    """E5: per (model, visitor) precision@10 against the warm U full truth."""
    s = Serving(spark, sf)
    u3 = _u3(s)
    return (ens.per_user_precision(s.all_recs(u3.select("visitorid")), u3, K)
            .withColumn("precision", F.round("precision", 6)))


@query("precision_at_k_zero", _ens_sql(
    "SELECT model, visitorid, CAST(0 AS BIGINT) AS hits, 0.0 AS precision FROM allrecs GROUP BY model, visitorid",
    None, _U3_USERS))
def q_precision_at_k_zero(spark, sf):
    """F8: the k = 0 guard (every precision is 0.0, no division)."""
    s = Serving(spark, sf)
    u3 = _u3(s)
    return ens.per_user_precision(s.all_recs(u3.select("visitorid")), u3, 0)


@query("borda_points", _ens_sql("SELECT visitorid, itemid, points, fused_rank FROM fused", None, _U3_USERS))
def q_borda_points(spark, sf):
    """Borda points over the four lists of every evaluation visitor."""
    s = Serving(spark, sf)
    return ens.borda_points(s.all_recs(_u3(s).select("visitorid")))


@query("borda_appears_in", _ens_sql(
    "SELECT visitorid, itemid, string_agg(upper(model), ', ' ORDER BY upper(model)) AS appears_in "
    "FROM allrecs GROUP BY visitorid, itemid", None, _U3_USERS))
def q_borda_appears_in(spark, sf):
    """Which models listed each item."""
    s = Serving(spark, sf)
    return ens.appears_in(s.all_recs(_u3(s).select("visitorid")))


@query("borda_with_hits", _ens_sql(
    "SELECT f.visitorid, f.fused_rank, f.itemid, f.points, a.appears_in, "
    "CASE WHEN t.itemid IS NOT NULL THEN 'YES' ELSE '-' END AS hit FROM fused f "
    "JOIN (SELECT visitorid, itemid, string_agg(upper(model), ', ' ORDER BY upper(model)) AS appears_in "
    "FROM allrecs GROUP BY visitorid, itemid) a USING (visitorid, itemid) "
    f"LEFT JOIN u3 t USING (visitorid, itemid) WHERE f.fused_rank <= {K}", None, _U3_USERS))
def q_borda_with_hits(spark, sf):
    """R10 + J11: the fused top-10 with points, appears-in and hit marker."""
    s = Serving(spark, sf)
    u3 = _u3(s)
    return ens.fused_report(s.all_recs(u3.select("visitorid")), u3, K)


@query("recs_side_by_side", serving_sql(
    "SELECT visitorid, CAST(rank AS INTEGER) AS rank, "
    + ", ".join(f"coalesce(max(CASE WHEN model = '{m}' THEN CAST(itemid AS VARCHAR) END), '-') AS {m}" for m in _ALL)
    + f" FROM ({_ALL_RECS}) GROUP BY visitorid, rank", _ALL))
def q_recs_side_by_side(spark, sf):
    """Rank x model table for the requested visitors."""
    return ens.side_by_side(Serving(spark, sf).all_recs())


@query("recs_per_model", serving_sql(
    "SELECT r.visitorid, m.model, CAST(count(a.itemid) AS BIGINT) AS n_recs FROM req r "
    "JOIN (VALUES ('als'), ('bpr'), ('lightfm'), ('svd')) m(model) ON TRUE "
    f"LEFT JOIN ({_ALL_RECS}) a ON a.visitorid = r.visitorid AND a.model = m.model GROUP BY r.visitorid, m.model", _ALL))
def q_recs_per_model(spark, sf):
    """List length per (requested visitor, model), 0 when absent."""
    s = Serving(spark, sf)
    return ens.recs_per_model(s.all_recs(), s.requested)


_ENS_BODY = (
    "SELECT " + ", ".join(
        f"round(coalesce(avg(CASE WHEN g.model = '{m}' THEN coalesce(pu.hits, 0) / {K}.0 END), 0.0), 6) "
        f"AS {m}_precision_at_k" for m in list(_ALL) + ["combined"])
    + ", count(DISTINCT g.visitorid) AS num_users_evaluated, "
    "(SELECT count(DISTINCT visitorid) FROM u3) AS num_users_available FROM "
    "(SELECT w.visitorid, m.model FROM wl w JOIN (VALUES ('als'), ('bpr'), ('lightfm'), ('svd'), ('combined')) "
    "m(model) ON TRUE) g LEFT JOIN pu USING (model, visitorid)")
_ENS_EXTRA = [
    "wl AS (SELECT DISTINCT visitorid FROM allrecs WHERE visitorid IN (SELECT visitorid FROM u3))",
    "lists AS (SELECT model, visitorid, rank, itemid FROM allrecs UNION ALL "
    "SELECT 'combined', visitorid, fused_rank, itemid FROM fused)",
    f"pu AS (SELECT model, visitorid, count(t.itemid) AS hits FROM (SELECT * FROM lists WHERE rank <= {K}) l "
    "LEFT JOIN u3 t USING (visitorid, itemid) GROUP BY model, visitorid)",
]


def _ensemble(spark, sf, phase="final", max_users=None, seed=42):
    s = Serving(spark, sf, phase)
    u3 = _u3(s)
    asked = serve.sample_users(u3, max_users, seed)
    return ens.evaluate_ensemble(s.all_recs(asked), u3, K, max_users=max_users, seed=seed)


def _sample_sql(users: str, n: int, seed: int = 42) -> str:
    return (f"SELECT visitorid FROM (SELECT DISTINCT visitorid FROM {users}) ORDER BY "
            f"('0x' || substr(md5(concat_ws('|', CAST(visitorid AS VARCHAR), '{seed}')), 1, 15))::BIGINT, visitorid LIMIT {n}")


@query("ensemble_precision", _ens_sql(_ENS_BODY, _ENS_EXTRA, _U3_USERS))
def q_ensemble_precision(spark, sf):
    """Fused and single-model Precision@10 on one common user set."""
    return _ensemble(spark, sf)


@query("ensemble_precision_validation", _ens_sql(_ENS_BODY, _ENS_EXTRA, _U3_USERS, "tune"))
def q_ensemble_precision_validation(spark, sf):
    """E6 on the validation set: the lists of the tuning phase against its evaluation period."""
    return _ensemble(spark, sf, "tune")


#: Users of the sampled evaluations.
SAMPLE = 100


@query("ensemble_precision_sampled", _ens_sql(
    _ENS_BODY, ["wl AS (SELECT DISTINCT visitorid FROM allrecs WHERE visitorid IN "
                f"({_sample_sql('u3', SAMPLE)}))"] + _ENS_EXTRA[1:], _U3_USERS))
def q_ensemble_precision_sampled(spark, sf):
    """E6 over a seeded sample of the users with truth (the sample is the feature)."""
    return _ensemble(spark, sf, max_users=SAMPLE)


@query("ensemble_improvement", _ens_sql(
    "SELECT combined_precision_at_k, greatest(als_precision_at_k, bpr_precision_at_k, lightfm_precision_at_k, "
    "svd_precision_at_k) AS best_single_precision_at_k, round(combined_precision_at_k - greatest(als_precision_at_k, "
    "bpr_precision_at_k, lightfm_precision_at_k, svd_precision_at_k), 6) AS abs_improvement, "
    "round(CASE WHEN greatest(als_precision_at_k, bpr_precision_at_k, lightfm_precision_at_k, svd_precision_at_k) > 0 "
    "THEN (combined_precision_at_k - greatest(als_precision_at_k, bpr_precision_at_k, lightfm_precision_at_k, "
    "svd_precision_at_k)) / greatest(als_precision_at_k, bpr_precision_at_k, lightfm_precision_at_k, "
    f"svd_precision_at_k) * 100 ELSE 0.0 END, 6) AS pct_improvement FROM ({_ENS_BODY})", _ENS_EXTRA, _U3_USERS))
def q_ensemble_improvement(spark, sf):
    """fused vs the best single model."""
    return ens.improvement(_ensemble(spark, sf))


# -------------------------------------------------------------------- training
from ..operators import als as alsmod  # noqa: E402
from ..operators import block_sgd  # noqa: E402

# fixed values: the reference's default hyperparameters per model
DEFAULTS = {
    "als": {"factors": 64, "regularization": 0.1, "iterations": 20},
    "bpr": {"factors": 64, "learning_rate": 0.01, "regularization": 0.01, "iterations": 100},
    "lightfm": {"no_components": 64, "learning_rate": 0.05, "loss": "warp", "epochs": 20},
    "svd": {"n_factors": 50, "n_epochs": 20, "lr_all": 0.005, "reg_all": 0.02},
}


def _eval_trained(s: Serving, model, uni_name: str, truth_scope: str, require_list=False, candidates=None):
    t = s.truth(truth_scope)
    recs = serve.recommend(model, s.uni(uni_name), t.select("visitorid"), K, candidates)
    return met.precision_recall_at_k(recs, t, K, require_list=require_list)


def _warm_train_cells(s: Serving):
    mats, d = inter.phase_bundle(s.sp, "warm")
    return mats["train_val" if s.sp.phase == "tune" else "train"], d


def train_model(s: Serving, name: str, params: dict | None = None, loss: str | None = None):
    """Fit one of the four models on the final training data with ``params`` over the defaults."""
    p = dict(DEFAULTS[name], **(params or {}))
    if name == "als":
        cells, d = _warm_train_cells(s)
        return alsmod.train_als(cells, d["visitorid"], d["itemid"], p["factors"], p["regularization"],
                                p["iterations"])
    if name == "svd":
        r = s.ratings.select(F.col("user_id").alias("u"), F.col("item_id").alias("i"), F.col("rating").alias("r"))
        return block_sgd.train_block_sgd(r, "svd", p["n_factors"], p["n_epochs"], p["lr_all"], p["reg_all"])
    # cells of weight 0 are no positives, but the hybrid's negatives are checked against them too
    cells = inter.raw_cells(s.sp.train).select(
        F.col("visitorid").alias("u"), F.col("itemid").alias("i"), F.col("weight").alias("r"))
    if name == "bpr":
        cells = cells.filter(F.col("r") != 0)
        return block_sgd.train_block_sgd(cells, "bpr", p["factors"], p["iterations"], p["learning_rate"],
                                         p["regularization"], gaussian_init=False)
    return block_sgd.train_block_sgd(cells, loss or p["loss"], p["no_components"], p["epochs"],
                                     p["learning_rate"], 0.0, gaussian_init=False, weighted=True, adaptive=True)


def training_pairs(s: Serving, name: str) -> DataFrame:
    """(visitorid, itemid, value) that the model called ``name`` is trained on: ratings, or non-zero cells."""
    if name == "svd":
        return s.ratings.select(F.col("user_id").alias("visitorid"), F.col("item_id").alias("itemid"),
                                F.col("rating").cast("double").alias("value"))
    return inter.raw_cells(s.sp.train).filter(F.col("weight") != 0).select(
        "visitorid", "itemid", F.col("weight").cast("double").alias("value"))


def learned(s: Serving, model, name: str) -> DataFrame:
    """One row: (pairs, share, rmse, spread, learned), what the model took from its training pairs.

    ``share``: pairs scored above the same user with a drawn item that is no
    pair of theirs; a model before its first step scores one half but for
    chance, and must be left behind by four standard errors.  For ratings the
    error on the training pairs must be below 95 % of their standard deviation,
    the error of a constant.
    """
    pairs = keep(training_pairs(s, name))
    blocks = FactorBlocks(model, pairs.count())
    items = global_index(pairs.select(F.col("itemid").alias("_other")).distinct(), [F.col("_other").asc()], "n")
    n_items = max(1, items.count())
    drawn = (pairs.withColumn("n", F.pmod(h(F.lit("other"), F.col("visitorid"), F.col("itemid")), F.lit(n_items)))
             .join(items, "n").join(pairs.select("visitorid", F.col("itemid").alias("_other")), ["visitorid", "_other"],
                                    "left_anti").select("visitorid", "itemid", "_other"))
    own = keep(predict_pairs(model, pairs, blocks=blocks))
    both = (own.join(drawn, ["visitorid", "itemid"]).select("visitorid", F.col("est").alias("_own"),
                                                            F.col("_other").alias("itemid")))
    share = predict_pairs(model, both, blocks=blocks).agg(
        F.count(F.lit(1)).alias("pairs"), F.avg(F.when(F.col("_own") > F.col("est"), 1.0)
                                                .when(F.col("_own") == F.col("est"), 0.5).otherwise(0.0)).alias("share"))
    near = own.agg(F.sqrt(F.avg((F.col("est") - F.col("value")) ** 2)).alias("rmse"),
                   F.stddev_pop("value").alias("spread"))
    ok = F.col("rmse") < 0.95 * F.col("spread") if name == "svd" else \
        F.col("share") > 0.5 + 4 * 0.5 / F.sqrt(F.col("pairs"))
    return inter.one_row([share, near]).withColumn("learned", F.coalesce(ok, F.lit(False)))


def list_checks(s: Serving, model, uni_name: str, truth_scope: str, label: str, trained_as: str) -> DataFrame:
    """What must hold of a trained model's lists: one row that SQL can name.

    lists: evaluation users with a list; entries: their length in total (k each,
    or all unseen items); seen_entries, bad_ranks, repeated: must be 0;
    bad_factors: factor rows with a null, infinite or missing component;
    learned: the model tells its training pairs from other pairs.
    """
    t = s.truth(truth_scope)
    uni = s.uni(uni_name)
    recs = keep(serve.recommend(model, uni, t.select("visitorid"), K))
    seen = recs.join(uni.seen.select("visitorid", "itemid").distinct(), ["visitorid", "itemid"], "left_semi")
    per = recs.groupBy("visitorid").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("itemid").alias("d"),
                                        F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    fine = F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    factors = model.user_factors.select("features").unionByName(model.item_factors.select("features"))
    return inter.one_row([
        t.agg(F.countDistinct("visitorid").alias("users"), F.count(F.lit(1)).alias("truth_pairs")),
        per.agg(F.count(F.lit(1)).alias("lists"), F.coalesce(F.sum("n"), F.lit(0)).alias("entries"),
                F.count(F.when((F.col("lo") != 1) | (F.col("hi") != F.col("n")), 1)).alias("bad_ranks"),
                F.count(F.when(F.col("n") != F.col("d"), 1)).alias("repeated")),
        seen.agg(F.count(F.lit(1)).alias("seen_entries")),
        factors.agg(F.count(F.when(~F.coalesce(fine, F.lit(False)), 1)).alias("bad_factors")),
        learned(s, model, trained_as).select("learned"),
    ]).select(F.lit(label).alias("model"), *[F.col(c).cast("long").alias(c) for c in _CHECKS], "learned")


_CHECKS = ("users", "truth_pairs", "lists", "entries", "bad_ranks", "repeated", "seen_entries", "bad_factors")


def _checks_sql(label: str, m: str, truth: str) -> str:
    """The same row from the data alone; a trained model knows the visitors and items it was trained on."""
    users, items, seen = {
        "als": ("SELECT visitorid FROM nz", "SELECT itemid FROM nz", "nz"),
        "als_foldin": ("SELECT visitorid FROM truth_warm", "SELECT itemid FROM nz", "nz"),
        "lightfm": ("SELECT visitorid FROM tr UNION ALL SELECT visitorid FROM fu", "SELECT itemid FROM tr", "nz"),
        "svd": ("SELECT user_id FROM hyb", "SELECT item_id FROM hyb", "hyb2"),
    }[m]
    return (f"SELECT '{label}' AS model, (SELECT count(DISTINCT visitorid) FROM {truth}) AS users, "
            f"(SELECT count(*) FROM {truth}) AS truth_pairs, count(*) AS lists, "
            f"CAST(coalesce(sum(least({K}, n_items - n_seen)), 0) AS BIGINT) AS entries, 0::BIGINT AS bad_ranks, "
            "0::BIGINT AS repeated, 0::BIGINT AS seen_entries, 0::BIGINT AS bad_factors, true AS learned FROM ("
            f"SELECT u.visitorid, (SELECT count(*) FROM (SELECT DISTINCT * FROM ({items}))) AS n_items, "
            f"(SELECT count(DISTINCT x.itemid) FROM {seen} x WHERE x.visitorid = u.visitorid) AS n_seen "
            f"FROM (SELECT DISTINCT visitorid FROM {truth}) u WHERE u.visitorid IN ({users})) WHERE n_items > n_seen")


def _training_sql(label: str, m: str, truth: str) -> str:
    return serving_sql(_checks_sql(label, m, truth), (), cand=[
        f"nz AS ({_NZ_SEEN})", "hyb2 AS (SELECT user_id AS visitorid, item_id AS itemid FROM hyb)"])


def _trained_query(name, uni_name, truth_scope, loss=None):
    def run(spark, sf):
        s = Serving(spark, sf)
        m = train_model(s, name, loss=loss)
        if name == "lightfm":
            m = serve.with_cold_users(m, s.uni("lightfm").users)
        return list_checks(s, m, uni_name, truth_scope, name if loss is None else f"{name}_{loss}", name)
    run.__doc__ = f"M1-M4: {name}{' ' + loss if loss else ''} trained with its defaults; what must hold of its lists."
    return run


query("als_train_recs", _training_sql("als", "als", "truth_warm"))(_trained_query("als", "als", "warm"))
query("bpr_train_recs", _training_sql("bpr", "als", "truth_warm"))(_trained_query("bpr", "bpr", "warm"))
for _loss in ("warp", "bpr", "logistic"):
    query(f"hybrid_{_loss}_recs", _training_sql(f"lightfm_{_loss}", "lightfm", "truth_full"))(
        _trained_query("lightfm", "lightfm", "full", loss=_loss))
query("svd_train_recs", _training_sql("svd", "svd", "truth_full"))(_trained_query("svd", "svd", "full"))


@query("als_foldin", _training_sql("als_foldin", "als_foldin", "truth_warm"))
def q_als_foldin(spark, sf):
    """M7: ALS user factors re-solved from train + eval cells (coded by the training events), for every truth visitor.

    A visitor needs no trained factor; one whose non-zero cells lie on untrained items only gets the zero factor.
    """
    s = Serving(spark, sf)
    m = train_model(s, "als")
    t = s.truth("warm")
    codes = dic.event_dictionary(s.sp.train).select(F.col("raw").alias("event"), F.col("idx").cast("double").alias("w"))
    profile = (s.sp.eval_warm.unionByName(s.sp.train).join(t.select("visitorid").distinct(), "visitorid", "left_semi")
               .join(F.broadcast(codes), "event").groupBy("visitorid", "itemid").agg(F.sum("w").alias("weight")))
    items = keep(m.item_factors)
    users = keep(alsmod.fold_in(profile, items, DEFAULTS["als"]["regularization"]))
    folded = serve.with_cold_users(block_sgd.FactorModel("dot", users, items), t.select("visitorid"))
    folded.user_factors = keep(folded.user_factors)
    return list_checks(s, folded, "als", "warm", "als_foldin", "als")


# ------------------------------------------------ names, reports, sinks, runs
from ..sources import models as model_store  # noqa: E402
from ..sources import runs as runlog  # noqa: E402
from ..sources import visitors as vis  # noqa: E402

_SETS = {"tune": "validation", "final": "test"}


def _md_sql(col: str) -> str:
    return f"lower(strftime({col}, '%b')) || CAST(day({col}) AS VARCHAR)"


def _fmt(v) -> str:
    return str(v).replace(".", "_")


def _exp_sql(model: str, eval_set: str) -> str:
    p = DEFAULTS.get(model, {})
    window = f"{_md_sql('lo')} || '_' || {_md_sql('hi')}"
    if model == "baseline":
        return f"'baseline_' || {window}"
    if model == "svd":
        return (f"'{eval_set}_svd_f{p['n_factors']}_e{p['n_epochs']}_lr{p['lr_all']}_r{p['reg_all']}'")
    if model == "lightfm":
        return (f"{window} || '_c{p['no_components']}_lr{_fmt(p['learning_rate'])}_{p['loss']}_e{p['epochs']}'")
    return f"{window} || '_f{p['factors']}_r{_fmt(p['regularization'])}_i{p['iterations']}'"


def _window(ph: str):
    """First and last day of the phase's training period, as configured."""
    lo, hi = FIXTURE_PERIODS[PHASES[ph][0]]
    return F.lit(lo).cast("date"), F.lit(hi).cast("date")


def _win_sql(ph: str) -> str:
    lo, hi = FIXTURE_PERIODS[PHASES[ph][0]]
    return f"win AS (SELECT DATE '{lo}' AS lo, DATE '{hi}' AS hi)"


_PROTOCOL = {"als": "warm", "bpr": "warm", "lightfm": "full", "svd": "full"}       # evaluation cells per model
_EVAL_USERS = "SELECT visitorid FROM truth_warm UNION SELECT visitorid FROM truth_full"


def _report_sql(ph: str) -> str:
    parts = []
    for m, scope in _PROTOCOL.items():
        x, cells = scope[0], "wa" if scope == "warm" else "fu"
        parts.append(
            f"SELECT '{_SETS[ph]}' AS eval_set, p.*, (SELECT count(*) FROM du_{x}) AS eval_users, "
            f"(SELECT count(*) FROM di_{x}) AS eval_items, "
            f"(SELECT count(*) FROM (SELECT DISTINCT visitorid, itemid FROM {cells})) AS eval_interactions "
            f"FROM ({_pr_sql(m, f'truth_{scope}', require_list=m == 'svd')}) p")
    return " UNION ALL ".join(parts)


def _report(spark, sf) -> DataFrame:
    """Precision / recall of the four frozen models on both evaluation sets, with the matrices' shapes."""
    parts = []
    for ph, es in _SETS.items():
        s = Serving(spark, sf, ph)
        shapes = {}
        for scope in ("warm", "full"):
            mats, d = inter.phase_bundle(s.sp, scope)
            shapes[scope] = keep(inter.matrix_stats(mats[f"{es}_{scope}"], d))
        # models of one truth are asked for the same visitors: those that know the same items share a scoring job
        lists = {}
        for scope in dict.fromkeys(_PROTOCOL.values()):
            lists |= s.recs_many([m for m in _PROTOCOL if _PROTOCOL[m] == scope], s.truth(scope).select("visitorid"))
        for m, scope in _PROTOCOL.items():
            t, st = s.truth(scope), shapes[scope]
            pr = met.precision_recall_at_k(lists[m], t, K, require_list=m == "svd")
            row = inter.one_row([pr, st.select(F.col("n_users").alias("eval_users"), F.col("n_items").alias("eval_items"),
                                               F.col("stored_cells").alias("eval_interactions"))])
            parts.append(row.select(F.lit(es).alias("eval_set"), F.lit(m).alias("model"), "*"))
    return union_all(parts)


@query("evaluation_report", both_phases(_report_sql, lambda ph: _serving_ctes(tuple(_PROTOCOL), _EVAL_USERS)))
def q_evaluation_report(spark, sf):
    """Metrics of every model plus the evaluation matrix's shape and stored cells, validation and test."""
    return _report(spark, sf)


def _pool_counts(sp: PhaseSplits):
    ranks = pop.popularity_ranks(pop.item_popularity(sp.train))
    n_items = pop.item_popularity(sp.train).count()
    pool = min(n_items, (pop.user_activity(sp.train).agg(F.max("n_events")).first()[0] or 0) + K)
    users = sp.eval_full.select("visitorid").distinct()
    seen = (sp.train.select("visitorid", "itemid").distinct().join(users, "visitorid", "left_semi")
            .join(ranks.filter(F.col("pop_rank") <= pool), "itemid")
            .groupBy("visitorid").agg(F.count(F.lit(1)).alias("seen_in_pool")))
    return (users.join(seen, "visitorid", "left")
            .select("visitorid", F.lit(pool).cast("long").alias("candidate_pairs"),
                    F.coalesce("seen_in_pool", F.lit(0)).cast("long").alias("seen_in_pool"))
            .withColumn("unseen_candidates", F.col("candidate_pairs") - F.col("seen_in_pool")))


_POOL_COUNT_SQL = (
    "SELECT u.visitorid, CAST(least((SELECT count(*) FROM ip), (SELECT n FROM pool)) AS BIGINT) AS candidate_pairs, "
    "CAST(count(s.itemid) AS BIGINT) AS seen_in_pool, "
    "CAST(least((SELECT count(*) FROM ip), (SELECT n FROM pool)) - count(s.itemid) AS BIGINT) AS unseen_candidates "
    "FROM us u LEFT JOIN (SELECT seen.visitorid, seen.itemid FROM seen JOIN rk USING (itemid) "
    "WHERE rk.pop_rank <= (SELECT n FROM pool)) s USING (visitorid) GROUP BY u.visitorid")


@query("candidate_pairs", phase_sql(lambda ph: _POOL_COUNT_SQL, lambda ph: _POPULAR_TOPK_CTES))
def q_candidate_pairs(spark, sf):
    """J7 without materialising it: per evaluation user, |pool| candidate pairs and how many were seen."""
    return per_phase(spark, sf, _pool_counts, stored_phases)


@query("unseen_candidates", phase_sql(
    lambda ph: f"SELECT visitorid, unseen_candidates FROM ({_POOL_COUNT_SQL})", lambda ph: _POPULAR_TOPK_CTES))
def q_unseen_candidates(spark, sf):
    """Per evaluation user, pool items not seen in training."""
    return per_phase(spark, sf, lambda sp: _pool_counts(sp).select("visitorid", "unseen_candidates"), stored_phases)


@query("visitor_list", with_sql("SELECT DISTINCT visitorid FROM p3"))
def q_visitor_list(spark, sf):
    """S8 (+ F4): the evaluation period's visitors written one per line and read back."""
    sp = phases(spark, sf)["final"]
    path = vis.write_visitors(sp.eval_full.select("visitorid").distinct(), scratch_path(spark, "visitors"))
    return vis.read_visitors(spark, path)


@query("recs_long_form", serving_sql("SELECT visitorid, CAST(rank AS INTEGER) AS rank, itemid FROM recs_als"))
def q_recs_long_form(spark, sf):
    """S9 + W3: ALS lists written as CSV (visitorid, rank, itemid) with a header and read back."""
    s = Serving(spark, sf)
    path = vis.write_recommendations(s.recs("als"), scratch_path(spark, "recs"))
    return vis.read_recommendations(spark, path)


def _fz_agg_sql(side: str, cte: str) -> str:
    return (f"SELECT '{side}' AS side, count(*) AS n, sum(bias) AS bias_sum, "
            + ", ".join(f"sum(f{d}) AS f{d}_sum" for d in range(4)) + f" FROM {cte}")


@query("model_store_roundtrip", serving_sql(
    _fz_agg_sql("user", "uf_svd") + " UNION ALL " + _fz_agg_sql("item", "if_svd"), ("svd",)))
def q_model_store_roundtrip(spark, sf):
    """A factor model saved (Parquet + JSON scalars) and loaded back, summarised per side."""
    s = Serving(spark, sf)
    back = model_store.load_model(spark, model_store.save_model(s.model("svd"), scratch_path(spark, "model")))
    assert back.kind == "svd" and back.global_mean == 3.0 and back.divisor == 100.0

    def agg(df, side):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum("bias").alias("bias_sum"),
                      *[F.sum(F.col("features")[d]).alias(f"f{d}_sum") for d in range(4)]) \
            .select(F.lit(side).alias("side"), "*")
    return agg(back.user_factors, "user").unionByName(agg(back.item_factors, "item"))


def _baseline_runs(spark, sf):
    parts = []
    for ph, sp in phases(spark, sf).items():
        es = _SETS[ph]
        exp = runlog.experiment_name("baseline", *_window(ph), es, {})
        metrics = pop.popular_precision(sp.train, sp.eval_full, K)
        parts.append(runlog.run_records(exp, runlog.run_name("baseline", es, exp),
                                        {"model_type": "baseline".upper(), "eval_set": es, "top_k": K}, metrics))
    return union_all(parts)


_RUNS_CTES = _POPULAR_TOPK_CTES + [
    "met AS (SELECT count(*) AS eval_users, CAST(coalesce(sum(hits), 0) AS BIGINT) AS hits, "
    "round(coalesce(avg(hits / n_recs), 0.0), 6) AS mean_precision FROM (SELECT r.visitorid, count(*) AS n_recs, "
    "count(t.itemid) AS hits FROM recs r LEFT JOIN (SELECT DISTINCT visitorid, itemid FROM fu) t "
    "USING (visitorid, itemid) GROUP BY r.visitorid))",
]


def _runs_long_sql(ph):
    es = _SETS[ph]
    exp = _exp_sql("baseline", es)
    rn = f"'baseline_evaluation_{es}_' || {exp}"
    rows = [f"SELECT {exp} AS experiment, {rn} AS run_name, 'param' AS kind, '{k}' AS key, '{v}' AS str_value, "
            f"CAST(NULL AS DOUBLE) AS num_value FROM win"
            for k, v in (("model_type", "BASELINE"), ("eval_set", es), ("top_k", str(K)))]
    rows += [f"SELECT {exp}, {rn}, 'metric', '{c}', CAST(NULL AS VARCHAR), CAST({c} AS DOUBLE) FROM win, met"
             for c in ("eval_users", "hits", "mean_precision")]
    return " UNION ALL ".join(rows)


@query("runs_log", both_phases(_runs_long_sql, lambda ph: _RUNS_CTES + [_win_sql(ph)]))
def q_runs_log(spark, sf):
    """Baseline evaluation runs appended to the run log, read back in long form."""
    path = runlog.log_runs(_baseline_runs(spark, sf), scratch_path(spark, "runs"))
    return runlog.runs_long(runlog.read_runs(spark, path))


def _model_runs(spark, sf) -> DataFrame:
    """Two evaluation runs per model and set: the second one repeats the first, so the best run is a tie."""
    report = _report(spark, sf).select("eval_set", "model", "users", "hits", "precision_at_k", "recall_at_k")
    report = keep(report)
    parts = []
    for ph, es in _SETS.items():
        for m in _PROTOCOL:
            exp = runlog.experiment_name(m, *_window(ph), es, DEFAULTS[m])
            row = report.filter((F.col("eval_set") == es) & (F.col("model") == m)).drop("eval_set", "model")
            for again in ("", "_again"):
                name = F.concat(runlog.run_name(m, es, exp), F.lit(again))
                parts.append(runlog.run_records(exp, name, {"model_type": m.upper(), "eval_set": es, "top_k": K}, row))
    return union_all(parts)


def _model_runs_sql(ph: str) -> str:
    es = _SETS[ph]
    return " UNION ALL ".join(
        f"SELECT {_exp_sql(m, es)} AS experiment, 'evaluation_{es}_' || {_exp_sql(m, es)} || '{again}' AS run_name, "
        f"'{m.upper()}' AS model_type, p.* EXCLUDE (model) FROM win, ({_pr_sql(m, f'truth_{scope}', m == 'svd')}) p"
        for m, scope in _PROTOCOL.items() for again in ("", "_again"))


def _model_runs_ctes(ph: str) -> list[str]:
    return _serving_ctes(tuple(_PROTOCOL), _EVAL_USERS) + [_win_sql(ph)]


@query("runs_log_models", "SELECT experiment, run_name, model_type, precision_at_k, recall_at_k FROM ("
       + both_phases(_model_runs_sql, _model_runs_ctes) + ")")
def q_runs_log_models(spark, sf):
    """S12 + F5: evaluation runs of the four models on both sets, logged and read back."""
    runs = runlog.read_runs(spark, runlog.log_runs(_model_runs(spark, sf), scratch_path(spark, "runs")))
    return runs.select("experiment", "run_name", F.col("params")["model_type"].alias("model_type"),
                       F.col("metrics")["precision_at_k"].alias("precision_at_k"),
                       F.col("metrics")["recall_at_k"].alias("recall_at_k"))


@query("runs_best", "SELECT experiment, run_name, precision_at_k FROM (SELECT *, row_number() OVER "
       "(PARTITION BY experiment ORDER BY precision_at_k DESC, run_name) AS rn FROM ("
       + both_phases(_model_runs_sql, _model_runs_ctes) + ")) WHERE rn = 1")
def q_runs_best(spark, sf):
    """The best logged run per experiment by a metric; ties go to the smaller run name."""
    runs = runlog.log_runs(_model_runs(spark, sf), scratch_path(spark, "runs"))
    runlog.log_runs(_baseline_runs(spark, sf), runs)         # appended; it has no precision_at_k
    return runlog.best_runs(runlog.read_runs(spark, runs), "precision_at_k")


def _training_sizes(sp: PhaseSplits, model: str) -> DataFrame:
    """Users, items and cells (for SVD: ratings) that ``model`` is trained on, one row."""
    if model == "svd":
        r = rat.hybrid_ratings(sp.train)
        return r.agg(F.countDistinct("user_id").alias("train_users"), F.countDistinct("item_id").alias("train_items"),
                     F.count(F.lit(1)).alias("train_ratings"))
    fit = sp.train if model != "lightfm" else sp.train.unionByName(sp.eval_full)
    ids = fit.agg(F.countDistinct("visitorid").alias("train_users"), F.countDistinct("itemid").alias("train_items"))
    return inter.one_row([ids, inter.raw_cells(sp.train).agg(F.count(F.lit(1)).alias("train_interactions"))])


def _training_runs_sql(ph: str) -> str:
    mode = ph
    parts = []
    for m in ("als", "bpr", "lightfm", "svd"):
        src = {"als": ("tr", "tr"), "bpr": ("tr", "tr"), "lightfm": ("trfu", "trfu"), "svd": ("hyb", "hyb")}[m]
        u, i = ("user_id", "item_id") if m == "svd" else ("visitorid", "itemid")
        n = "SELECT count(*) FROM hyb" if m == "svd" else \
            "SELECT count(*) FROM (SELECT DISTINCT visitorid, itemid FROM tr JOIN de ON tr.event = de.raw)"
        kind = "train_ratings" if m == "svd" else "train_interactions"
        parts.append(f"SELECT '{runlog.MODEL_EXPERIMENTS[m]}' AS experiment, 'training_{mode}' AS run_name, "
                     f"'{m.upper()}' AS model_type, CAST((SELECT count(DISTINCT {u}) FROM {src[0]}) AS DOUBLE) AS train_users, "
                     f"CAST((SELECT count(DISTINCT {i}) FROM {src[1]}) AS DOUBLE) AS train_items, "
                     f"'{kind}' AS counted, CAST(({n}) AS DOUBLE) AS train_rows")
    return " UNION ALL ".join(parts)


@query("runs_log_training", both_phases(_training_runs_sql, lambda ph: _ratings_ctes() + [
    "trfu AS (SELECT visitorid, itemid FROM tr UNION ALL SELECT visitorid, itemid FROM fu)"]))
def q_runs_log_training(spark, sf):
    """Training runs of the four models in both modes; every run is logged twice and read back once."""
    parts = []
    for ph, sp in phases(spark, sf).items():
        window = FIXTURE_PERIODS[PHASES[ph][0]]
        parts += [runlog.training_run(m, ph, DEFAULTS[m], window, _training_sizes(sp, m)) for m in DEFAULTS]
    runs = union_all(parts).checkpoint()
    path = runlog.log_runs(runs, scratch_path(spark, "runs"))
    back = runlog.read_runs(spark, runlog.log_runs(runs, path))
    m = F.col("metrics")
    return back.select("experiment", "run_name", F.col("params")["model_type"].alias("model_type"),
                       m["train_users"].alias("train_users"), m["train_items"].alias("train_items"),
                       F.when(m["train_ratings"].isNull(), "train_interactions").otherwise("train_ratings").alias("counted"),
                       F.coalesce(m["train_ratings"], m["train_interactions"]).alias("train_rows"))


def _ensemble_run_sql(ph: str) -> str:
    es = _SETS[ph]
    names = ("combined", *_ALL)
    best = "greatest(" + ", ".join(f"{m}_precision_at_k" for m in _ALL) + ")"
    rows = [f"SELECT '{es}_{m}_precision_at_k' AS key, {m}_precision_at_k AS value FROM ens" for m in names]
    rows += [f"SELECT '{es}_improvement_over_best', round(combined_precision_at_k - {best}, 6) FROM ens"]
    rows += [f"SELECT '{c}', CAST({c} AS DOUBLE) FROM ens" for c in ("num_users_evaluated", "num_users_available")]
    return _ens_sql(f"SELECT '{runlog.ENSEMBLE_EXPERIMENT}' AS experiment, 'combined_borda_count_{es}' AS run_name, key, "
                    f"CAST(value AS DOUBLE) AS value FROM ({' UNION ALL '.join(rows)})",
                    _ENS_EXTRA + [f"ens AS ({_ENS_BODY})"], _U3_USERS, ph)


@query("runs_log_ensemble", " UNION ALL ".join(f"SELECT * FROM ({_ensemble_run_sql(ph)})" for ph in PHASES))
def q_runs_log_ensemble(spark, sf):
    """Ensemble evaluations on the validation and the test set, logged and read back in long form."""
    path = scratch_path(spark, "runs")
    for ph, es in _SETS.items():
        runlog.log_runs(runlog.ensemble_run(es, K, FIXTURE_PERIODS[PHASES[ph][0]], _ensemble(spark, sf, ph)), path)
    return runlog.runs_long(runlog.read_runs(spark, path)).where("kind = 'metric'").select(
        "experiment", "run_name", "key", F.col("num_value").alias("value"))


# ---------------------------------------------------------------------- tuning
from ..operators import tuning as tun  # noqa: E402

#: The parameter of each model that counts passes: trials that differ in it alone share a fit.
_PASSES = {"als": "iterations", "bpr": "iterations", "lightfm": "epochs", "svd": "n_epochs"}


def fit_trials(tune: Serving, model: str, points: list[dict]) -> list:
    """One trained model per point, on the tuning phase's training data; all points are trained by the same jobs."""
    passes = _PASSES[model]
    groups: dict[tuple, set] = {}
    for p in points:
        groups.setdefault(tuple((k, v) for k, v in p.items() if k != passes), set()).add(p[passes])
    shared = {g: i for i, g in enumerate(groups)}
    params = [dict(g) | {passes: max(n), "report": tuple(sorted(n))} for g, n in groups.items()]
    rows = training_pairs(tune, model) if model in ("als", "bpr", "svd") else \
        inter.raw_cells(tune.sp.train).withColumn("value", F.col("weight").cast("double"))
    rows = rows.select(F.col("visitorid").alias("u"), F.col("itemid").alias("i"), F.col("value").alias("r"))
    if model == "als":
        fitted = alsmod.fit_als_blocks(rows, [alsmod.AlsFit(p["factors"], p["regularization"], p["iterations"],
                                                            report=p["report"]) for p in params])
    elif model == "svd":
        fitted = block_sgd.fit_blocks(rows, [block_sgd.Fit("svd", p["n_factors"], p["n_epochs"], p["lr_all"],
                                                           p["reg_all"], report=p["report"]) for p in params])
    elif model == "bpr":
        fitted = block_sgd.fit_blocks(rows, [block_sgd.Fit(
            "bpr", p["factors"], p["iterations"], p["learning_rate"], p["regularization"], gaussian_init=False,
            report=p["report"]) for p in params])
    else:
        fitted = block_sgd.fit_blocks(rows, [block_sgd.Fit(
            p["loss"], p["no_components"], p["epochs"], p["learning_rate"], 0.0, gaussian_init=False, weighted=True,
            adaptive=True, report=p["report"]) for p in params])
    return [fitted[shared[tuple((k, v) for k, v in p.items() if k != passes)]][p[passes]] for p in points]


def score_trials(tune: Serving, model: str, fitted: list) -> DataFrame:
    """(trial, precision_at_k, recall_at_k) of the models on the tuning phase's validation cells, in one scoring job."""
    t, uni = tune.truth(_PROTOCOL[model]), tune.uni(model)
    # all trials know the same visitors
    cold = keep(serve.cold_users(fitted[0], uni.users)) if model == "lightfm" else None
    recs = serve.recommend_many({str(n): m for n, m in enumerate(fitted)}, uni, t.select("visitorid"), K, cold=cold)
    return met.precision_recall_per_model(recs, t, K, [str(n) for n in range(len(fitted))], require_list=model == "svd") \
        .select(F.col("model").cast("int").alias("trial"), "precision_at_k", "recall_at_k")


def tune_model(spark, sf, model: str, space: dict | None = None, n_trials: int = tun.DEFAULT_TRIALS,
               seed: int = 42, tune: Serving | None = None) -> DataFrame:
    """H1: seeded search of ``space`` (default: the model's own) with up to ``n_trials`` trials."""
    space = space or tun.SEARCH_SPACES[model]
    trials = tun.sample_trials(tun.search_grid(spark, space), n_trials, seed)
    tune = tune or Serving(spark, sf, "tune")
    return tun.run_trials(trials, lambda points: score_trials(tune, model, fit_trials(tune, model, points)), space)


def _trials_sql(model: str, space: dict) -> str:
    """The seeded choice of grid points, and that every trial has metrics between 0 and 1."""
    grid = " CROSS JOIN ".join(f"(VALUES {', '.join(f"('{v}')" for v in vals)}) t_{k}({k})" for k, vals in space.items())
    params = " || ',' || ".join(f"'\"{k}\":\"' || {k} || '\"'" for k in space)
    return (f"SELECT '{model}' AS model, CAST(row_number() OVER (ORDER BY {_h('params')}, params) - 1 AS INTEGER) AS trial, "
            f"params, true AS scored FROM (SELECT '{{' || {params} || '}}' AS params FROM {grid})")


@query("tuning_trials", "SELECT model, trial, params, scored FROM (" + " UNION ALL ".join(
    _trials_sql(m, space) for m, space in tun.SEARCH_SPACES.items()) + f") WHERE trial < {tun.DEFAULT_TRIALS}")
def q_tuning_trials(spark, sf):
    """H1 (+ H2, X2): the four models searched over their own spaces, one row per trial; scored: both metrics in [0, 1]."""
    tune = Serving(spark, sf, "tune")
    out = union_all([tune_model(spark, sf, m, tune=tune).select(F.lit(m).alias("model"), "*") for m in tun.SEARCH_SPACES])
    return out.select("model", "trial", "params", F.coalesce(
        F.col("precision_at_k").between(0, 1) & F.col("recall_at_k").between(0, 1), F.lit(False)).alias("scored"))


# Searches whose objective SQL can repeat: "factors" picks the tag of the frozen factors.
_FROZEN_SPACE = {"factors": [16, 32, 64, 128], "iterations": [10]}


def _frozen_trials(spark, sf) -> DataFrame:
    s = Serving(spark, sf, "tune")
    t, u = s.truth("warm"), s.uni("als")

    def run(points):
        models = {str(n): frozen_model(f"als_{p['factors']}", u.users.select(F.col("visitorid").alias("raw")),
                                       u.items.select(F.col("itemid").alias("raw")), kind="dot")
                  for n, p in enumerate(points)}
        recs = serve.recommend_many(models, u, t.select("visitorid"), K)
        return met.precision_recall_per_model(recs, t, K, list(models)).select(
            F.col("model").cast("int").alias("trial"), "precision_at_k", "recall_at_k")
    return tun.run_trials(tun.sample_trials(tun.search_grid(spark, _FROZEN_SPACE)), run, _FROZEN_SPACE)


def _frozen_trials_sql(body: str) -> str:
    tags = [f"als_{f}" for f in _FROZEN_SPACE["factors"]]
    rows = " UNION ALL ".join(
        f"SELECT '{{\"factors\":\"{f}\",\"iterations\":\"10\"}}' AS params, '{f}' AS factors, p.precision_at_k, "
        f"p.recall_at_k FROM ({_pr_sql(f'als_{f}', 'truth_warm')}) p" for f in _FROZEN_SPACE["factors"])
    trials = (f"trials AS (SELECT CAST(row_number() OVER (ORDER BY {_h('params')}, params) - 1 AS INTEGER) AS trial, * "
              f"FROM ({rows}))")
    best = "best AS (SELECT * FROM trials ORDER BY precision_at_k DESC, trial LIMIT 1)"
    ctes = _serving_ctes(tuple(tags), "SELECT DISTINCT visitorid FROM truth_warm") + [trials, best]
    return with_sql(body, "tune", ctes)


@query("frozen_trials", _frozen_trials_sql("SELECT trial, params, precision_at_k, recall_at_k FROM trials"))
def q_frozen_trials(spark, sf):
    """H1 with an objective that SQL repeats: frozen factors, one tag per grid point."""
    return _frozen_trials(spark, sf)


@query("runs_log_tuning", _frozen_trials_sql(
    f"SELECT '{runlog.MODEL_EXPERIMENTS['als']}' AS experiment, 'trial_' || (trial + 1) AS run_name, "
    "CAST(trial + 1 AS VARCHAR) AS trial_number, factors, precision_at_k AS validation_precision_at_k, "
    "recall_at_k AS validation_recall_at_k FROM trials"))
def q_runs_log_tuning(spark, sf):
    """One run per trial of a search, logged and read back."""
    runs = runlog.tuning_runs("als", _frozen_trials(spark, sf), list(_FROZEN_SPACE))
    back = runlog.read_runs(spark, runlog.log_runs(runs, scratch_path(spark, "runs")))
    p, m = F.col("params"), F.col("metrics")
    return back.select("experiment", "run_name", p["trial_number"].alias("trial_number"), p["factors"].alias("factors"),
                       m["validation_precision_at_k"].alias("validation_precision_at_k"),
                       m["validation_recall_at_k"].alias("validation_recall_at_k"))


@query("best_trial", _frozen_trials_sql("SELECT trial, params, precision_at_k, recall_at_k FROM best"))
def q_best_trial(spark, sf):
    """H3: the best trial of the search."""
    return tun.best_trial(_frozen_trials(spark, sf))


_OLD_DOC = [("als", "factors", "256"), ("als", "regularization", "0.5"), ("bpr", "factors", "128"),
            ("bpr", "learning_rate", "0.1")]


def _params_doc(spark, sf) -> str:
    """The best trial upserted into a document that already holds two models."""
    params = (tun.best_trial(_frozen_trials(spark, sf)).select(F.from_json("params", "map<string,string>").alias("m"))
              .select(F.explode("m").alias("param", "value")))
    old = runlog.write_params_doc(spark.createDataFrame(_OLD_DOC, "model string, param string, value string"),
                                  scratch_path(spark, "params-old"))
    return runlog.write_params_doc(runlog.upsert_params(runlog.read_params_doc(spark, old), "als", params),
                                   scratch_path(spark, "params"))


_DOC_SQL = ("SELECT 'als' AS model, 'factors' AS param, factors AS value FROM best UNION ALL "
            "SELECT 'als', 'iterations', '10' FROM best UNION ALL "
            + " UNION ALL ".join(f"SELECT '{m}', '{k}', '{v}'" for m, k, v in _OLD_DOC if m != "als"))


@query("params_upsert", _frozen_trials_sql(_DOC_SQL))
def q_params_upsert(spark, sf):
    """The best trial's parameters replace their model's entry in the document; other models stay."""
    return runlog.read_params_doc(spark, _params_doc(spark, sf))


@query("params_resolved", _frozen_trials_sql(
    "SELECT d.model, d.param, coalesce(x.value, d.value) AS value, x.value IS NOT NULL AS from_document FROM (VALUES "
    + ", ".join(f"('{m}', '{k}', '{v}')" for m, ps in DEFAULTS.items() for k, v in ps.items())
    + f") d(model, param, value) LEFT JOIN ({_DOC_SQL}) x ON d.model = x.model AND d.param = x.param"))
def q_params_resolved(spark, sf):
    """S10 (+ F13): per model and parameter, the document's value or the default."""
    return runlog.resolve_params(runlog.read_params_doc(spark, _params_doc(spark, sf)), DEFAULTS)


# ------------------------------------------------------------- remaining reports
_TOPN = 10_000      # default of the top-N reports


@query("popular_by_weight", serving_sql(
    f"SELECT itemid, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, itemid) AS INTEGER) AS position "
    f"FROM ipop ORDER BY cnt DESC, itemid LIMIT {_TOPN}", (), cand=_CAND_HYB))
def q_popular_by_weight(spark, sf, n: int = _TOPN):
    """T4 (+ A13): the ``n`` items with the largest summed training weight."""
    from pyspark.sql import Window
    s = Serving(spark, sf)
    popw = inter.raw_cells(s.sp.train).groupBy("itemid").agg(F.sum("weight").cast("double").alias("cnt"))
    top = pop.top_popular(popw, n)
    # n rows: numbering them in one partition is bounded
    return top.withColumn("position", F.row_number().over(
        Window.orderBy(F.col("cnt").desc(), F.col("itemid").asc())).cast("int"))


@query("popular_by_ratings", serving_sql(
    f"SELECT itemid, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, itemid) AS INTEGER) AS position "
    f"FROM rpop ORDER BY cnt DESC, itemid LIMIT {_TOPN}", (), cand=_CAND_SVD))
def q_popular_by_ratings(spark, sf, n: int = _TOPN):
    """T4 (+ A14): the ``n`` items rated most often."""
    from pyspark.sql import Window
    s = Serving(spark, sf)
    rpop = pop.item_popularity(s.ratings.select(F.col("item_id").alias("itemid")))
    return pop.top_popular(rpop, n).withColumn("position", F.row_number().over(
        Window.orderBy(F.col("cnt").desc(), F.col("itemid").asc())).cast("int"))


@query("items_per_user", phase_sql(
    lambda ph: "SELECT u.visitorid, coalesce(r.items, '') AS rec_items, t.n_truth FROM "
               "(SELECT visitorid, count(DISTINCT itemid) AS n_truth FROM fu GROUP BY visitorid) t "
               "JOIN us u USING (visitorid) LEFT JOIN (SELECT visitorid, string_agg(CAST(itemid AS VARCHAR), ',' "
               "ORDER BY rank) AS items FROM recs GROUP BY visitorid) r USING (visitorid)",
    lambda ph: _POPULAR_TOPK_CTES))
def q_items_per_user(spark, sf):
    """The popularity list per evaluation user (<= k items, in order) and the size of its truth set."""
    def one(sp):
        recs = pop.recommend_popular(sp.train, sp.eval_full.select("visitorid"), K)
        lists = (recs.groupBy("visitorid")
                 .agg(F.sort_array(F.collect_list(F.struct("rank", "itemid"))).alias("_l"))    # <= k entries
                 .select("visitorid", F.array_join(F.transform("_l", lambda x: x["itemid"].cast("string")), ",")
                         .alias("rec_items")))
        truth = sp.eval_full.groupBy("visitorid").agg(F.countDistinct("itemid").alias("n_truth"))
        return (truth.join(lists, "visitorid", "left")
                .select("visitorid", F.coalesce("rec_items", F.lit("")).alias("rec_items"), "n_truth"))
    return per_phase(spark, sf, one)
