"""H1-H3, S10-S13, F3, F4 on hand-made inputs."""

from pyspark.sql import functions as F


def test_search_grid_sizes(spark):
    from rankfold.operators.tuning import search_grid
    sizes = {m: search_grid(spark, m).count() for m in ("als", "bpr", "lightfm", "svd")}
    assert sizes == {"als": 64, "bpr": 108, "lightfm": 108, "svd": 108}
    assert search_grid(spark, "als").select("params").distinct().count() == 64


def test_sample_trials_is_seeded(spark):
    from rankfold.operators.tuning import sample_trials, search_grid
    g = search_grid(spark, "svd")
    a = [r["params"] for r in sample_trials(g, 5, seed=7).orderBy("trial").collect()]
    b = [r["params"] for r in sample_trials(g, 5, seed=7).orderBy("trial").collect()]
    c = [r["params"] for r in sample_trials(g, 5, seed=8).orderBy("trial").collect()]
    assert a == b and len(set(a)) == 5 and a != c


def test_tuning_trials_search_the_models_spaces(spark, monkeypatch):
    import json
    import __spark_entry__ as entry
    from conftest import SF_SMALL
    from rankfold.operators.tuning import DEFAULT_TRIALS, SEARCH_SPACES
    from rankfold.plans import catalog
    tried = {}

    def fit_trials(_, model, points):                        # no training here
        tried[model] = points
        return points

    def score_trials(_, model, fitted):
        return spark.createDataFrame([(n, 0.5, 1.5 if n == 7 else 0.25) for n in range(len(fitted))],
                                     "trial int, precision_at_k double, recall_at_k double")
    monkeypatch.setattr(catalog, "fit_trials", fit_trials)
    monkeypatch.setattr(catalog, "score_trials", score_trials)
    rows = entry.queries()["tuning_trials"](spark, SF_SMALL).collect()
    assert {m: sum(r["model"] == m for r in rows) for m in SEARCH_SPACES} == {m: DEFAULT_TRIALS for m in SEARCH_SPACES}
    for m, space in SEARCH_SPACES.items():
        assert all(list(p) == list(space) and all(p[k] in space[k] for k in p) for p in tried[m])
        assert len({json.dumps(p) for p in tried[m]}) == DEFAULT_TRIALS
    assert all(r["scored"] == (r["trial"] != 7) for r in rows)


def test_trials_share_fits(spark):
    """Points that differ only in their passes share a fit; each point gets the factors of its own number of passes."""
    import numpy as np
    from conftest import SF_SMALL
    from rankfold.plans import catalog
    tune = catalog.Serving(spark, SF_SMALL, "tune")
    points = [{"n_factors": 4, "n_epochs": e, "lr_all": 0.01, "reg_all": 0.02} for e in (3, 1)]
    points.append({"n_factors": 4, "n_epochs": 1, "lr_all": 0.005, "reg_all": 0.02})
    fitted = catalog.fit_trials(tune, "svd", points)
    assert [m.params["epochs"] for m in fitted] == [3, 1, 1] and [m.params["lr"] for m in fitted] == [0.01, 0.01, 0.005]
    alone = catalog.train_model(tune, "svd", points[1])
    get = lambda m: {r["id"]: r["features"] for r in m.item_factors.collect()}
    a, b = get(fitted[1]), get(alone)
    assert a.keys() == b.keys() and all(np.array_equal(a[k], b[k]) for k in a)
    scored = catalog.score_trials(tune, "svd", fitted).orderBy("trial").collect()
    assert [r["trial"] for r in scored] == [0, 1, 2]
    one = catalog._eval_trained(tune, alone, "svd", "full", True).first()
    assert (scored[1]["precision_at_k"], scored[1]["recall_at_k"]) == (one["precision_at_k"], one["recall_at_k"])


def test_best_trial_ties_go_to_earliest(spark):
    from rankfold.operators.tuning import best_trial
    t = spark.createDataFrame([(0, "a", 0.1, 0.2), (1, "b", 0.3, 0.1), (2, "c", 0.3, 0.9)],
                              "trial int, params string, precision_at_k double, recall_at_k double")
    assert best_trial(t).first()["trial"] == 1


def test_params_upsert_and_resolve(spark, tmp_path):
    from rankfold.plans.catalog import DEFAULTS
    from rankfold.sources import runs
    doc_path = str(tmp_path / "doc.json")
    with open(doc_path, "w") as fh:
        fh.write('{\n  "als": {"factors": 256, "regularization": 0.01},\n  "bpr": {"factors": 128}\n}\n')
    doc = runs.read_params_doc(spark, doc_path)
    new = spark.createDataFrame([("factors", "32")], "param string, value string")
    up = runs.upsert_params(doc, "als", new)
    got = {(r["model"], r["param"]): r["value"] for r in up.collect()}
    assert got == {("als", "factors"): "32", ("bpr", "factors"): "128"}
    res = {(r["model"], r["param"]): (r["value"], r["from_document"])
           for r in runs.resolve_params(up, DEFAULTS).collect()}
    assert res[("als", "factors")] == ("32", True)
    assert res[("als", "regularization")] == ("0.1", False)        # dropped by the upsert -> default
    assert res[("bpr", "factors")] == ("128", True)
    assert res[("svd", "n_epochs")] == ("20", False)
    out = str(tmp_path / "doc2")
    runs.write_params_doc(up, out)
    again = {(r["model"], r["param"]): r["value"] for r in runs.read_params_doc(spark, out).collect()}
    assert again == got


def test_best_runs_and_long_form(spark):
    from rankfold.sources import runs
    m = spark.createDataFrame([("e1", "r1", 0.2), ("e1", "r2", 0.5), ("e2", "r3", 0.1)],
                              "exp string, rn string, precision_at_k double")
    recs = runs.run_records(F.col("exp"), F.col("rn"), {"top_k": 10}, m.select("exp", "rn", "precision_at_k"))
    best = {r["experiment"]: r["run_name"] for r in runs.best_runs(recs, "precision_at_k").collect()}
    assert best == {"e1": "r2", "e2": "r3"}
    assert runs.runs_long(recs).count() == 6


def test_experiment_name_format(spark):
    from rankfold.sources.runs import experiment_name, run_name
    df = spark.createDataFrame([("2015-05-03", "2015-06-18")], "a string, b string") \
        .select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    als = experiment_name("als", F.col("a"), F.col("b"), "validation",
                          {"factors": 64, "regularization": 0.1, "iterations": 20})
    lfm = experiment_name("lightfm", F.col("a"), F.col("b"), "validation",
                          {"no_components": 64, "learning_rate": 0.05, "loss": "warp", "epochs": 20})
    svd = experiment_name("svd", F.col("a"), F.col("b"), "validation",
                          {"n_factors": 50, "n_epochs": 20, "lr_all": 0.005, "reg_all": 0.02})
    r = df.select(als.alias("als"), lfm.alias("lfm"), svd.alias("svd"),
                  run_name("baseline", "test", experiment_name("baseline", F.col("a"), F.col("b"), "test", {}))
                  .alias("base")).first()
    assert r["als"] == "may3_jun18_f64_r0_1_i20"
    assert r["lfm"] == "may3_jun18_c64_lr0_05_warp_e20"
    assert r["svd"] == "validation_svd_f50_e20_lr0.005_r0.02"
    assert r["base"] == "baseline_evaluation_test_baseline_may3_jun18"


def test_visitor_list_parsing(spark, tmp_path):
    from rankfold.sources.visitors import parse_visitor_list, read_visitors
    p = tmp_path / "ids.txt"
    p.write_text("1150086\n\n 895999 \n316850\n")
    assert [r["visitorid"] for r in read_visitors(spark, str(p)).collect()] == [1150086, 895999, 316850]
    arr = spark.createDataFrame([("123, 456,,789",)], "s string").select(parse_visitor_list(F.col("s"))).first()[0]
    assert arr == [123, 456, 789]


def test_hybrid_losses_learn_planted_groups(spark):
    """Two user groups x two item groups: every loss ranks the own group's unseen items first."""
    from rankfold.operators.block_sgd import train_block_sgd
    from rankfold.operators.factors import predict_pairs
    rows = [(u, i, 1.0) for u in range(40) for i in range(40) if (u % 2) == (i % 2) and (u + i) % 4 != 0]
    df = spark.createDataFrame(rows, "u long, i long, r double")
    pairs = spark.createDataFrame([(u, i) for u in range(40) for i in range(40)], "visitorid long, itemid long")
    for loss in ("bpr", "warp", "logistic"):
        m = train_block_sgd(df, loss, 8, 30, 0.05, 0.001, blocks=2, gaussian_init=False)
        p = predict_pairs(m, pairs).withColumn("same", (F.col("visitorid") % 2) == (F.col("itemid") % 2))
        means = {r["same"]: r["m"] for r in p.groupBy("same").agg(F.avg("est").alias("m")).collect()}
        assert means[True] > means[False], loss
