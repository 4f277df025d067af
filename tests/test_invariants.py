"""Invariants of the non-SQL operators on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_global_index_equals_dense_rank(spark):
    from pyspark.sql import Window
    from rankfold.operators.ranking import global_index
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 10007).alias("v")).distinct()
    got = global_index(df, [F.col("v").asc()], "idx", num_partitions=7)
    want = df.withColumn("r", F.dense_rank().over(Window.orderBy("v")) - 1)
    bad = got.join(want, "v").filter(F.col("idx") != F.col("r")).count()
    assert bad == 0 and got.count() == df.count()


def test_split_laws(spark):
    from rankfold.plans.catalog import phases
    for sp in phases(spark, SF_SMALL).values():
        key = ["visitorid", "itemid", "timestamp", "event"]
        warm, cold, full = (d.select(*key) for d in (sp.eval_warm, sp.eval_cold, sp.eval_full))
        assert warm.intersect(cold).count() == 0
        assert warm.union(cold).exceptAll(full).count() == 0
        rest = full.exceptAll(warm).exceptAll(cold)
        seen_users = sp.train.select("visitorid").distinct()
        seen_items = sp.train.select("itemid").distinct()
        # the remainder is exactly "seen user, unseen item"
        assert rest.join(seen_users, "visitorid", "left_anti").count() == 0
        assert rest.join(seen_items, "itemid", "left_semi").count() == 0


def test_precision_recall_hand_example(spark):
    from rankfold.operators.metrics import precision_recall_at_k
    recs = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 3, 1), (2, 4, 2)], "visitorid long, itemid long, rank int")
    truth = spark.createDataFrame([(1, 1), (1, 5), (2, 3)], "visitorid long, itemid long")
    r = precision_recall_at_k(recs, truth, 10).first()
    assert r["precision_at_k"] == pytest.approx(0.1)
    assert r["recall_at_k"] == pytest.approx(0.75)


def test_borda_ties_and_unequal_lengths(spark):
    from rankfold.operators.ensemble import borda_points
    rows = [("als", 1, 1, 10), ("als", 1, 2, 20), ("als", 1, 3, 30),
            ("bpr", 1, 1, 20), ("bpr", 1, 2, 10),
            ("svd", 1, 1, 40)]
    recs = spark.createDataFrame(rows, "model string, visitorid long, rank int, itemid long")
    got = {r["itemid"]: (r["points"], r["fused_rank"]) for r in borda_points(recs).collect()}
    # max length 3: rank1 -> 3, rank2 -> 2, rank3 -> 1
    assert got[10] == (5, 1) and got[20] == (5, 2)        # tie on points, smaller id first
    assert got[40] == (3, 3) and got[30] == (1, 4)


def test_lists_are_well_formed(spark):
    import __spark_entry__ as entry
    recs = entry.queries()["recs_all_models"](spark, SF_SMALL)
    g = recs.groupBy("model", "visitorid").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("itemid").alias("d"),
                                               F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    assert g.filter((F.col("n") > 10) | (F.col("n") != F.col("d")) | (F.col("lo") != 1)
                    | (F.col("hi") != F.col("n"))).count() == 0


def test_unknown_visitor_gets_empty_list(spark):
    from rankfold.operators import serving as serve
    from rankfold.plans.catalog import Serving
    s = Serving(spark, SF_SMALL)
    req = spark.createDataFrame([(-1,)], "visitorid long")
    out = serve.recommend_batch(s.recs("als", requested=req), req).first()
    assert out["n_items"] == 0 and out["items"] == ""


def _plain_svd(ratings, P, Q, mu, lr, reg, epochs, orders):
    bu = {u: 0.0 for u in P}
    bi = {i: 0.0 for i in Q}
    for e in range(epochs):
        for u, i, r in sorted(ratings, key=lambda x: orders[(x[0], x[1], e)]):
            err = r - (mu + bu[u] + bi[i] + P[u].dot(Q[i]))
            bu[u] += lr * (err - reg * bu[u])
            bi[i] += lr * (err - reg * bi[i])
            puf = P[u].copy()
            P[u] = P[u] + lr * (err * Q[i] - reg * P[u])
            Q[i] = Q[i] + lr * (err * puf - reg * Q[i])
    return P, Q, bu, bi


def test_svd_block_sgd_single_block_equals_plain_loop(spark):
    from rankfold.operators.block_sgd import init_vector, row_order, train_block_sgd
    rng = np.random.default_rng(3)
    data = [(int(u), int(i), float(r)) for u, i, r in
            zip(rng.integers(0, 30, 200), rng.integers(0, 40, 200), rng.integers(1, 6, 200))]
    data = list({(u, i): (u, i, r) for u, i, r in data}.values())
    df = spark.createDataFrame(data, "u long, i long, r double")
    f, epochs, lr, reg, seed = 5, 3, 0.01, 0.02, 42
    m = train_block_sgd(df, "svd", f, epochs, lr, reg, seed=seed, blocks=1)
    init = lambda ids, side: {r["id"]: init_vector(r["id"], f, side, seed, True, 0.1) for r in ids.collect()}
    P0 = init(df.select(F.col("u").alias("id")).distinct(), "user")
    Q0 = init(df.select(F.col("i").alias("id")).distinct(), "item")
    orders = {}
    for e in range(epochs):
        for u, i, _ in data:
            orders[(u, i, e)] = int(row_order(np.array([u]), np.array([i]), e, seed)[0])
    mu = float(np.mean([r for _, _, r in data]))
    P, Q, bu, bi = _plain_svd(data, P0, Q0, mu, lr, reg, epochs, orders)
    for r in m.user_factors.collect():
        assert np.allclose(r["features"], P[r["id"]], atol=1e-9) and abs(r["bias"] - bu[r["id"]]) < 1e-9
    for r in m.item_factors.collect():
        assert np.allclose(r["features"], Q[r["id"]], atol=1e-9) and abs(r["bias"] - bi[r["id"]]) < 1e-9


def test_block_sgd_is_deterministic_and_learns(spark):
    from rankfold.operators.block_sgd import train_block_sgd
    from rankfold.operators.factors import predict_pairs
    rows = spark.createDataFrame([(u, i, 5.0 if (u % 2) == (i % 2) else 1.0) for u in range(20) for i in range(20)
                                  if (u + i) % 3], "u long, i long, r double")
    a = train_block_sgd(rows, "svd", 4, 30, 0.05, 0.02, blocks=2)
    b = train_block_sgd(rows, "svd", 4, 30, 0.05, 0.02, blocks=2)
    fa = sorted((r["id"], tuple(r["features"])) for r in a.user_factors.collect())
    fb = sorted((r["id"], tuple(r["features"])) for r in b.user_factors.collect())
    assert fa == fb
    pairs = rows.select(F.col("u").alias("visitorid"), F.col("i").alias("itemid"), "r")
    a.user_factors, a.item_factors = a.user_factors, a.item_factors
    pred = predict_pairs(a, pairs)
    rmse = pred.agg(F.sqrt(F.avg((F.col("est") - F.col("r")) ** 2))).first()[0]
    assert rmse < 1.5      # the constant predictor has rmse 2.0


def test_foldin_reproduces_als_user_factors(spark):
    from rankfold.operators import als as alsmod
    from rankfold.operators import interactions as inter
    from rankfold.plans.catalog import phases
    sp = phases(spark, SF_SMALL)["final"]
    mats, d = inter.phase_bundle(sp, "warm")
    m = alsmod.train_als(mats["train"], d["visitorid"], d["itemid"], rank=4, reg=0.1, iterations=10)
    prof = inter.raw_cells(sp.train)
    folded = alsmod.fold_in(prof, m.item_factors, 0.1)
    j = (folded.select("id", F.col("features").alias("x"))
         .join(m.user_factors.select("id", F.col("features").alias("y")), "id").collect())
    assert len(j) > 50
    err = max(float(np.max(np.abs(np.array(r["x"]) - np.array(r["y"])))) for r in j)
    assert err < 1e-3


def test_foldin_serves_visitors_without_a_trained_factor(spark):
    import __spark_entry__ as entry
    r = entry.queries()["als_foldin"](spark, "/root/testdata/sf0.01").first()
    assert r["lists"] == r["users"] and r["entries"] == 10 * r["users"]
    assert r["seen_entries"] == r["bad_ranks"] == r["repeated"] == r["bad_factors"] == 0


def test_gram_matches_numpy(spark):
    from rankfold.operators.als import gram
    rng = np.random.default_rng(1)
    Y = rng.normal(size=(300, 6))
    df = spark.createDataFrame([(i, [float(x) for x in Y[i]]) for i in range(300)], "id long, features array<double>")
    assert np.allclose(gram(df.repartition(5), 6), Y.T @ Y, atol=1e-9)


def test_phase_from_store_equals_built_phase(spark):
    from rankfold.plans.catalog import phases
    from rankfold.session import scratch_path
    from rankfold.sources.events import tpch_events
    from rankfold.sources.stores import phase_from_store, write_splits
    path = write_splits(tpch_events(spark, SF_SMALL), scratch_path(spark, "test-splits"))
    built = phases(spark, SF_SMALL)["tune"]
    back = phase_from_store(spark, path, "tune")
    key = ["visitorid", "itemid", "event", "timestamp"]
    for attr in ("train", "eval_full", "eval_warm", "eval_cold"):
        a, b = getattr(built, attr).select(*key), getattr(back, attr).select(*key)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sample_weights_matter(spark):
    """M3: weights scale the steps; a cell of weight 0 is no positive but is never drawn as a negative."""
    from rankfold.operators.block_sgd import Negatives, train_block_sgd

    def fit(loss, weight, weighted=True):
        rows = spark.createDataFrame([(u, i, float(weight(u, i))) for u in range(12) for i in range(12) if (u + i) % 4 < 2],
                                     "u long, i long, r double")
        m = train_block_sgd(rows, loss, 4, 2, 0.05, 0.0, blocks=1, gaussian_init=False, weighted=weighted)
        return {r["id"]: (np.array(r["features"]), r["bias"]) for r in m.item_factors.collect()}
    for loss in ("warp", "bpr", "logistic"):
        flat, tilted = fit(loss, lambda u, i: 1), fit(loss, lambda u, i: 1 + 9 * (i % 2))
        assert any(not np.allclose(flat[i][0], tilted[i][0]) for i in flat)
        plain = fit(loss, lambda u, i: 1 + 9 * (i % 2), weighted=False)
        assert all(np.allclose(flat[i][0], plain[i][0]) for i in flat)
    gone = fit("bpr", lambda u, i: 0 if i == 5 else 1)
    assert gone[5][1] <= 0                                   # never pushed up, only ever drawn as a negative
    draw = Negatives(np.array([0, 0, 1]), np.array([0, 2, 1]), 3, 3, np.random.default_rng(0)).draw
    assert set(draw(np.zeros(50, int))) == {1} and 1 not in set(draw(np.ones(50, int)))


def test_blocks_follow_the_data_not_the_cores(spark):
    from rankfold.operators.block_sgd import train_block_sgd
    rows = spark.range(900).select((F.col("id") % 30).alias("u"), (F.col("id") / 30).cast("long").alias("i"),
                                   (F.col("id") % 5 + 1).cast("double").alias("r"))
    a = train_block_sgd(rows, "svd", 3, 2, 0.05, 0.02, rows_per_cell=100)
    assert a.params["blocks"] == 3
    b = train_block_sgd(rows.repartition(7), "svd", 3, 2, 0.05, 0.02, rows_per_cell=100)
    pick = lambda m: {r["id"]: tuple(r["features"]) for r in m.user_factors.collect()}
    assert pick(a) == pick(b)


def test_conflict_free_batches():
    from rankfold.operators.block_sgd import conflict_free
    rng = np.random.default_rng(5)
    u, i = rng.integers(0, 9, 200), rng.integers(0, 7, 200)
    batches = conflict_free(u, i)
    assert sorted(np.concatenate(batches).tolist()) == list(range(200))
    at = {n: k for k, b in enumerate(batches) for n in b.tolist()}
    for b in batches:
        assert len(set(u[b])) == len(b) == len(set(i[b]))
    for n in range(200):
        for m in range(n):
            if u[m] == u[n] or i[m] == i[n]:
                assert at[m] < at[n]
