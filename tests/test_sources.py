"""Reading by name, time order in files, no hidden limits."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_csv_log_is_read_by_name(spark, tmp_path):
    from rankfold.sources.events import read_events, read_raw_events
    path = tmp_path / "events.csv"
    path.write_text("timestamp,visitorid,event,itemid,transactionid,extra\n1433221332117,257597,view,355908,,x\n"
                    "1433224214164,992329,transaction,248676,4000,y\n")
    rows = read_raw_events(spark, str(path)).orderBy("timestamp").collect()
    assert [tuple(r) for r in rows] == [(257597, 1433221332117, "view", 355908, None),
                                        (992329, 1433224214164, "transaction", 248676, 4000)]
    assert str(read_events(spark, str(path)).orderBy("timestamp").first()["date"]) == "2015-06-02"
    path.write_text("timestamp,visitorid,event\n1,2,view\n")
    with pytest.raises(ValueError, match="itemid, transactionid"):
        read_raw_events(spark, str(path))


def test_split_files_are_in_time_order(spark, tmp_path):
    from rankfold.sources.events import tpch_events
    from rankfold.sources.stores import write_splits
    write_splits(tpch_events(spark, SF_SMALL), str(tmp_path / "s"))
    files = glob.glob(str(tmp_path / "s" / "split=*" / "*.parquet"))
    assert len({f.split("split=")[1].split("/")[0] for f in files}) == 8
    per = {}
    for f in files:
        t = pq.read_table(f, columns=["timestamp"]).column(0).to_pylist()
        assert t == sorted(t)
        per.setdefault(f.rsplit("/", 1)[0], []).append((t[0], t[-1]))
    for spans in per.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))       # files do not overlap in time


def test_candidates_have_no_hidden_limit(spark):
    from rankfold.operators.serving import candidate_items
    pop = spark.range(25_000).select(F.col("id").alias("itemid"), (F.col("id") % 7).cast("double").alias("cnt"))
    ev = spark.range(24_000, 26_000).select(F.col("id").alias("itemid"))
    assert candidate_items(ev, pop).count() == 26_000
    assert candidate_items(ev, pop, top_n=10).count() == 2_010
    assert candidate_items(ev, pop, cap=100).count() == 100


def test_top_n_is_an_argument(spark):
    from rankfold.plans.catalog import q_popular_by_ratings, q_popular_by_weight
    for q in (q_popular_by_weight, q_popular_by_ratings):
        full, some = q(spark, SF_SMALL).orderBy("position").collect(), q(spark, SF_SMALL, n=7).orderBy("position").collect()
        assert len(some) == 7 < len(full) and some == full[:7]


def test_event_weights_map(spark):
    from rankfold.operators.interactions import SIGNAL_WEIGHTS, raw_cells
    ev = spark.createDataFrame([(1, 5, "view"), (1, 5, "view"), (1, 5, "transaction"), (2, 5, "addtocart")],
                               "visitorid long, itemid long, event string")
    got = {(r.visitorid, r.itemid): r.weight for r in raw_cells(ev, SIGNAL_WEIGHTS).collect()}
    assert got == {(1, 5): 5.0, (2, 5): 2.0}


def test_popular_precision_denominator(spark):
    from rankfold.operators.popularity import popular_precision
    train = spark.createDataFrame([(1, 10), (2, 10), (2, 11)], "visitorid long, itemid long")
    ev = spark.createDataFrame([(1, 11)], "visitorid long, itemid long")
    assert popular_precision(train, ev, 10).first()["mean_precision"] == 1.0
    assert popular_precision(train, ev, 10, denominator="k").first()["mean_precision"] == 0.1


def test_salted_pool_join_equals_broadcast(spark, monkeypatch):
    from rankfold.operators import popularity as pop
    from rankfold.plans.catalog import phases
    sp = phases(spark, SF_SMALL)["final"]
    a = sorted(map(tuple, pop.recommend_popular(sp.train, sp.eval_full.select("visitorid")).collect()))
    monkeypatch.setattr(pop, "POOL_BROADCAST_ROWS", 0)
    assert a == sorted(map(tuple, pop.recommend_popular(sp.train, sp.eval_full.select("visitorid")).collect()))


def test_pick_fraction_is_the_lowest_hashes(spark):
    from rankfold.functions.hashing import h
    from rankfold.operators.ratings import pick_fraction
    pairs = spark.range(3_001).select((F.col("id") % 50).alias("visitorid"), F.col("id").alias("itemid"))
    order = (pairs.withColumn("x", h(F.col("visitorid"), F.col("itemid"), F.lit("pick"), seed=7))
             .orderBy("x", "visitorid", "itemid").collect())
    for pct in (0.0, 0.2, 0.5, 1.0):
        got = {r.itemid for r in pick_fraction(pairs, pct, 7).collect()}
        assert got == {r.itemid for r in order[:int(3_001 * pct)]}, pct


def test_bucketed_store_joins_without_a_shuffle(spark):
    from rankfold.plans.catalog import stored_sums
    from rankfold.sources.stores import read_bucketed, write_bucketed
    cells = spark.range(3000).selectExpr("id % 100 AS user_idx", "id % 7 AS item_idx", "CAST(id % 5 AS double) AS weight")
    users = spark.range(100).selectExpr("id + 1000 AS raw", "id AS idx")
    a = read_bucketed(spark, write_bucketed(cells, "user_idx", 8), "user_idx", 8)
    b = read_bucketed(spark, write_bucketed(users, "idx", 8), "idx", 8)
    out = stored_sums(a, b)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in stored_sums(cells, users)._jdf.queryExecution().executedPlan().toString()
    got, want = ({tuple(r) for r in x.collect()} for x in (out, stored_sums(cells, users)))
    assert got == want and len(got) == 100
