"""Trained models: epoch reports, block invariance, adaptive steps, metrics against untrained models, run log."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankfold.operators import als as alsmod
from rankfold.operators import block_sgd as sgd
from rankfold.operators import metrics as met
from rankfold.operators.scoring import score_topk


def factors(df):
    return {r["id"]: np.array(r["features"]) for r in df.collect()}


def apart(a, b):
    a, b = factors(a), factors(b)
    assert a.keys() == b.keys()
    return max(np.abs(a[k] - b[k]).max() for k in a)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    data = [(int(u), int(i), float(1 + (u + i) % 3)) for u in range(60) for i in range(50)
            if rng.random() < 0.25 and (u % 2 == i % 2 or rng.random() < 0.1)]
    return spark.createDataFrame(data, "u long, i long, r double")


@pytest.mark.parametrize("loss,adaptive", [("svd", False), ("bpr", False), ("warp", True), ("logistic", True)])
def test_a_shorter_fit_is_a_prefix(rows, loss, adaptive):
    long, short = sgd.fit_blocks(rows, [sgd.Fit(loss, 4, 5, 0.05, 0.01, adaptive=adaptive, report=(0, 2)),
                                        sgd.Fit(loss, 4, 2, 0.05, 0.01, adaptive=adaptive)], blocks=2)
    assert sorted(long) == [0, 2, 5] and sorted(short) == [2]
    assert apart(long[2].user_factors, short[2].user_factors) == 0
    assert apart(long[2].item_factors, short[2].item_factors) == 0
    assert apart(long[0].item_factors, long[5].item_factors) > 0 and long[2].params["epochs"] == 2


def test_als_blocks_report_and_agree(rows):
    one = alsmod.fit_als_blocks(rows, [alsmod.AlsFit(5, 0.1, 30, report=(1, 8)), alsmod.AlsFit(5, 0.1, 8)])
    assert apart(one[0][8].user_factors, one[1][8].user_factors) == 0
    three = alsmod.fit_als_blocks(rows, [alsmod.AlsFit(5, 0.1, 8)], blocks=3)
    assert apart(one[0][8].user_factors, three[0][8].user_factors) < 1e-9
    model, profile = one[0][30], rows.selectExpr("u AS visitorid", "i AS itemid", "r AS weight")
    exact = alsmod.fold_in(profile, model.item_factors, 0.1)
    assert apart(exact, alsmod.fold_in(profile, model.item_factors, 0.1, blocks=3)) < 1e-9
    assert apart(exact, model.user_factors) < 5e-3            # converged conjugate gradients against the exact solution


def test_fold_in_leaves_out_unknown_items(spark):
    items = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 2.0])], "id long, features array<double>")
    profile = spark.createDataFrame([(1, 7, 1.0), (1, 99, 5.0), (2, 99, 1.0), (3, 8, 0.0)],
                                    "visitorid long, itemid long, weight double")
    got = factors(alsmod.fold_in(profile, items, 0.5))
    assert set(got) == {1}                                    # one known item; (1 + 1 + 0.5) x = 2
    assert np.allclose(got[1], [2 / 2.5, 0.0])


def logistic_loss(spark, rows, model):
    from rankfold.operators.factors import predict_pairs
    pairs = rows.select(F.col("u").alias("visitorid"), F.col("i").alias("itemid"))
    return -predict_pairs(model, pairs).agg(F.avg(F.log(1 / (1 + F.exp(-F.col("est")))))).first()[0]


def test_adaptive_steps_learn_faster_and_repeat(spark, rows):
    plain, fast, again = (sgd.fit_blocks(rows, [sgd.Fit("logistic", 4, 8, 0.05, 0.0, gaussian_init=False, adaptive=a)],
                                         blocks=2)[0][8] for a in (False, True, True))
    assert apart(fast.user_factors, again.user_factors) == 0
    assert logistic_loss(spark, rows, fast) != logistic_loss(spark, rows, plain)
    big_plain, big_fast = (sgd.fit_blocks(rows, [sgd.Fit("warp", 4, 10, 2.0, 0.0, gaussian_init=False, adaptive=a)])[0][10]
                           for a in (False, True))
    size = lambda m: max(np.abs(x).max() for x in factors(m.item_factors).values())
    assert size(big_fast) < size(big_plain)                   # a large rate is tamed


def test_adaptive_step_by_hand():
    s = sgd.Side(np.arange(2), np.zeros((2, 1)), np.zeros(2), np.ones((2, 1)), np.ones(2))
    s.move(np.array([0]), np.array([[3.0]]), np.array([4.0]), 0.1)
    assert s.m[0, 0] == pytest.approx(0.3) and s.gm[0, 0] == 10 and s.b[0] == pytest.approx(0.4) and s.gb[0] == 17
    s.move(np.array([0, 0]), np.array([[1.0], [2.0]]), None, 0.1)
    assert s.m[0, 0] == pytest.approx(0.3 + 0.3 / np.sqrt(10)) and s.gm[0, 0] == 15


def planted(spark):
    """Two groups of users and items; a fifth of the own group's pairs is held out."""
    rng = np.random.default_rng(7)
    pairs = [(u, i) for u in range(60) for i in range(60) if u % 2 == i % 2]
    held = {p for p in pairs if rng.random() < 0.2}
    train = [(u, i, 5.0) for u, i in pairs if (u, i) not in held]
    low = [(u, i, 1.0) for u in range(60) for i in range(60) if u % 2 != i % 2 and rng.random() < 0.5]
    return (spark.createDataFrame(train, "u long, i long, r double"), spark.createDataFrame(train + low, "u long, i long, r double"),
            spark.createDataFrame(sorted(held), "visitorid long, itemid long"))


def test_metrics_of_trained_models(spark):
    """Precision and recall of every trained model on held-out pairs, against the same model before its first step."""
    cells, ratings, truth = planted(spark)
    users = truth.select(F.col("visitorid").alias("u")).distinct()

    def metrics(model):
        lists = score_topk(model, users, 6, seen=cells.select("u", "i")).select(
            F.col("u").alias("visitorid"), F.col("i").alias("itemid"), "rank")
        r = met.precision_recall_at_k(lists, truth, 6).first()
        return r["precision_at_k"], r["recall_at_k"]
    ids = cells.select("u").distinct().select(F.col("u").alias("idx"), F.col("u").alias("raw"))
    items = cells.select("i").distinct().select(F.col("i").alias("idx"), F.col("i").alias("raw"))
    als = alsmod.train_als(cells.select(F.col("u").alias("user_idx"), F.col("i").alias("item_idx"), F.col("r").alias("weight")),
                           ids, items, 4, 0.1, 10)
    models = {"als": (als, alsmod.fit_als_blocks(cells, [alsmod.AlsFit(4, 0.1, 0)])[0][0]),
              "als blocks": tuple(alsmod.fit_als_blocks(cells, [alsmod.AlsFit(4, 0.1, 10, report=(0,))])[0][t] for t in (10, 0))}
    for loss, rows, lr, extra in (("svd", ratings, 0.02, {}), ("bpr", cells, 0.05, {"gaussian_init": False}),
                                  ("bpr hybrid", cells, 0.05, {"gaussian_init": False, "adaptive": True, "weighted": True}),
                                  ("warp", cells, 0.05, {"gaussian_init": False, "adaptive": True, "weighted": True}),
                                  ("logistic", cells, 0.05, {"gaussian_init": False, "adaptive": True, "weighted": True})):
        got = sgd.fit_blocks(rows, [sgd.Fit(loss.split()[0], 6, 40, lr, 0.001, report=(0,), **extra)])[0]
        models[loss] = (got[40], got[0])
    best = truth.count() / (6 * truth.select("visitorid").distinct().count())
    for name, (trained, raw) in models.items():
        (p, r), (p0, r0) = metrics(trained), metrics(raw)
        assert p > 0.7 * min(best, 1.0) and r > 0.7, (name, p, r)
        assert p > 1.3 * p0 and r > 1.3 * r0, (name, p, p0, r, r0)


def test_metrics_per_model_equal_single_metrics(spark):
    recs = spark.createDataFrame([("a", 1, 1, 1), ("a", 1, 2, 2), ("a", 2, 3, 1), ("b", 1, 5, 1)],
                                 "model string, visitorid long, itemid long, rank int")
    truth = spark.createDataFrame([(1, 1), (1, 5), (2, 3), (3, 9)], "visitorid long, itemid long")
    for need in (False, True):
        many = {r["model"]: r for r in met.precision_recall_per_model(recs, truth, 2, ["a", "b", "none"], require_list=need).collect()}
        for m in ("a", "b", "none"):
            one = met.precision_recall_at_k(recs.where(F.col("model") == m), truth, 2, require_list=need).first()
            assert {c: many[m][c] for c in one.asDict()} == one.asDict()


def test_learned_fails_for_an_untrained_model(spark):
    from conftest import SF_SMALL
    from rankfold.plans import catalog
    s = catalog.Serving(spark, SF_SMALL)
    for name in ("bpr", "lightfm", "svd"):
        raw = catalog.train_model(s, name, {catalog._PASSES[name]: 0})
        assert not catalog.learned(s, raw, name).first()["learned"], name


def test_plan_of_a_step_does_not_grow_with_blocks(spark, rows, monkeypatch):
    """Every step is one job over flat tasks: as many jobs as steps, none of them with a shuffle of factors."""
    calls = []
    real = sgd.run_tasks
    monkeypatch.setattr(sgd, "run_tasks", lambda spark, tasks, fn: (calls.append(len(tasks)), real(spark, tasks, fn)))
    sgd.fit_blocks(rows, [sgd.Fit("svd", 3, 2, 0.05, 0.02)], blocks=3)
    assert calls == [3] * 6


@pytest.mark.parametrize("held", [sgd.HELD_BYTES, 0])
def test_one_stage_of_many_steps_equals_a_job_per_step(rows, monkeypatch, held):
    """Long fits run without a job per step: the same factors, whatever the number of tasks at once and what they keep."""
    fits = [sgd.Fit("bpr", 4, 12, 0.05, 0.01, gaussian_init=False, report=(0, 3, 10)),
            sgd.Fit("warp", 3, 7, 0.05, 0.0, gaussian_init=False, adaptive=True, report=(2,))]
    with monkeypatch.context() as m:
        m.setattr(sgd, "gang_size", lambda spark: 0)
        plain = sgd.fit_blocks(rows, fits, blocks=3)
    jobs, real = [], sgd.run_tasks
    monkeypatch.setattr(sgd, "run_tasks", lambda spark, tasks, fn: (jobs.append(len(tasks)), real(spark, tasks, fn)))
    monkeypatch.setattr(sgd, "HELD_BYTES", held)
    for size in (2, 4):
        monkeypatch.setattr(sgd, "gang_size", lambda spark, size=size: size)
        long = sgd.fit_blocks(rows, fits, blocks=3)
        for x, y in zip(plain, long, strict=True):
            assert sorted(x) == sorted(y)
            for e in x:
                assert apart(x[e].user_factors, y[e].user_factors) == apart(x[e].item_factors, y[e].item_factors) == 0
    assert jobs == [3, 3]                          # the factors before the first step; no other job per step


def test_rows_are_cut_for_parallel_steps(spark, monkeypatch):
    """Blocks for parallel tasks as long as each has rows enough; a gang is asked for only where its size is known."""
    from rankfold.operators import cells
    monkeypatch.setattr(cells, "ROWS_PER_TASK", 100)
    data = spark.range(1000).selectExpr("id % 90 AS u", "id % 77 AS i", "1.0 AS r")
    assert cells.Cells(data).blocks == 1 and cells.Cells(data, tasks=24).blocks == 10
    assert cells.Cells(data, tasks=4).blocks == 4 and cells.Cells(data, blocks=2, tasks=24).blocks == 2
    assert cells.gang_size(spark) == spark.sparkContext.defaultParallelism


def test_one_run_logged_twice_is_one_run(spark, tmp_path):
    from rankfold.sources import runs
    sizes = spark.createDataFrame([(3, 4, 9)], "train_users long, train_items long, train_interactions long")
    run = runs.training_run("als", "tune", {"factors": 8}, ("1995-01-01", "1996-02-29"), sizes)
    path = str(tmp_path / "runs")
    for _ in range(2):
        runs.log_runs(run, path)
    runs.log_runs(runs.training_run("als", "tune", {"factors": 16}, ("1995-01-01", "1996-02-29"), sizes), path)
    back = runs.read_runs(spark, path).collect()
    assert sorted(r["params"]["factors"] for r in back) == ["16", "8"]
    assert all(r["metrics"] == {"train_users": 3.0, "train_items": 4.0, "train_interactions": 9.0} for r in back)
    assert {r["experiment"] for r in back} == {"ALS_Recommendation_System"} and back[0]["run_name"] == "training_tune"
    trials = spark.createDataFrame([(0, '{"factors":"32"}', 0.1, 0.2)], "trial int, params string, precision_at_k double, "
                                   "recall_at_k double")
    t = runs.tuning_runs("bpr", trials, ["factors"]).first()
    assert t["run_name"] == "trial_1" and t["params"] == {"factors": "32", "model_type": "BPR", "trial_number": "1"}
    assert t["metrics"] == {"validation_precision_at_k": 0.1, "validation_recall_at_k": 0.2}


def test_one_pass_matrices_equal_single_matrices(spark):
    from conftest import SF_SMALL
    from rankfold.operators import interactions as inter
    from rankfold.plans.catalog import phases
    from rankfold.sources.events import tpch_events
    weights = {"view": 1.0, "addtocart": 2.5, "transaction": 4.0}
    long = inter.all_interactions(inter.period_sums(tpch_events(spark, SF_SMALL)), weights).checkpoint()
    key = ["user_idx", "item_idx", "weight"]
    for ph, sp in phases(spark, SF_SMALL).items():
        for scope in ("warm", "full"):
            for name, c in inter.phase_bundle(sp, scope, weights)[0].items():
                mine = long.where((F.col("phase") == ph) & (F.col("scope") == scope) & (F.col("matrix") == name)).select(*key)
                assert mine.exceptAll(c.select(*key)).count() == c.select(*key).exceptAll(mine).count() == 0 < mine.count()


def test_factor_files_are_not_taken_for_small(spark, rows):
    """A table of factors read from block files has no known size, so no join collects it for a broadcast."""
    from rankfold.operators.factors import predict_pairs
    from rankfold.operators.serving import cold_users
    model = sgd.fit_blocks(rows, [sgd.Fit("bpr", 4, 1, 0.05, 0.01)], blocks=2)[0][1]
    pairs = rows.selectExpr("u AS visitorid", "i AS itemid")
    for df in (predict_pairs(model, pairs), cold_users(model, pairs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("loss", ["svd", "warp", "als"])
def test_pairs_scored_by_block_equal_joined_pairs(spark, rows, loss, monkeypatch):
    """Known, unknown and null ids, other columns, a user side without files: the rows of the joins, no factor shuffled."""
    from rankfold.operators import factors as fac
    from rankfold.operators.serving import with_cold_users
    if loss == "als":
        model = alsmod.fit_als_blocks(rows, [alsmod.AlsFit(4, 0.1, 2)], blocks=3)[0][2]
        model.user_files = model.item_files = None
    else:
        model = sgd.fit_blocks(rows, [sgd.Fit(loss, 4, 2, 0.05, 0.01)], blocks=3)[0][2]
    pairs = rows.selectExpr("u AS visitorid", "i AS itemid", "r AS value").unionByName(spark.createDataFrame(
        [(1, 999, 0.5), (999, 1, None), (None, 1, 2.0), (1, None, 2.0), (500, 3, 1.0)], "visitorid long, itemid long, value double"))
    pairs = pairs.unionByName(pairs.limit(40))                # rows that come twice
    monkeypatch.setattr(fac, "PAIR_ROWS", 30)
    for m in (model, with_cold_users(model, spark.createDataFrame([(500,)], "visitorid long"))):
        by_join, by_block = (sorted(map(tuple, df.collect()), key=str) for df in (
            fac.predict_pairs(m, pairs), fac.predict_pairs(m, pairs, blocks=fac.FactorBlocks(m, pairs.count(), 20))))
        assert len(by_join) == len(by_block) == pairs.count()
        for a, b in zip(by_join, by_block):
            assert a[:3] == b[:3] and a[4] == b[4] and a[3] == pytest.approx(b[3], abs=1e-12)


def test_blocks_hold_more_ids_where_factors_are_short():
    short, wide = sgd.Fit("bpr", 64, 1, 0.1, 0.0), sgd.Fit("warp", 256, 1, 0.1, 0.0, adaptive=True)
    assert sgd.ids_of_a_block([short]) > 250_000 and sgd.ids_of_a_block([short, wide]) == 65_536
    assert sgd.ids_of_a_block([sgd.Fit("warp", 64, 1, 0.1, 0.0, adaptive=True)]) * 16 * 65 <= sgd.BLOCK_BYTES


def test_block_files_keep_arrays(tmp_path):
    from rankfold.sources.blockfiles import load_block, save_block
    arrays = {"ids": np.arange(5), "m": np.arange(12.0).reshape(3, 4).T, "none": np.empty((0, 3)), "f": np.float32([1.5])}
    save_block(str(tmp_path), "x", **arrays)
    back = load_block(str(tmp_path), "x")
    assert list(back) == list(arrays) and all(back[k].dtype == arrays[k].dtype and np.array_equal(back[k], arrays[k]) for k in arrays)
    back["m"][0, 0] = 7.0                                     # training changes blocks in place
    assert list(load_block(str(tmp_path), "x", ("m",))) == ["m"] and load_block(str(tmp_path), "y") is None


def test_als_keeps_no_shuffles_of_earlier_iterations(spark, rows):
    """The shuffles that a fit holds on to do not grow with its iterations."""
    import gc
    import time
    dicts = [rows.select(F.col(c).alias("raw"), F.col(c).alias("idx")).distinct() for c in "ui"]
    cells = rows.select(F.col("u").alias("user_idx"), F.col("i").alias("item_idx"), F.col("r").alias("weight"))
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()

    def held():
        return set(tracker.shuffleStatuses().keySet().mkString(",").split(","))

    def left(iterations, at_most=0):
        before = held()
        model = alsmod.train_als(cells, *dicts, rank=2, iterations=iterations, num_blocks=2)
        until = time.monotonic() + 6
        while len(held() - before) > at_most and time.monotonic() < until:      # what nothing refers to goes with the garbage
            gc.collect()
            spark._jvm.System.gc()
            time.sleep(0.5)
        return len(held() - before), model
    few = left(2)[0]
    assert left(4, few)[0] <= few
