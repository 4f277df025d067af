"""Queries of both phases read a log that was joined once, and get the same splits from it."""

import datetime as dt

SPLITS = ("train", "eval_full", "eval_warm", "eval_cold")


def _tables(spark, folder):
    days = [dt.datetime(1995, 1, 1), dt.datetime(1996, 2, 29), dt.datetime(1996, 3, 1), dt.datetime(1998, 5, 1),
            dt.datetime(2001, 8, 1), dt.datetime(2001, 8, 2), dt.datetime(1994, 12, 31), None]
    orders = [(n, n % 5, days[n % len(days)]) for n in range(40)] + [(40, None, days[0])]
    lines = [(n % 42, n % 7 if n % 11 else None, "NAR"[n % 3]) for n in range(150)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(
        f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_returnflag string").write.parquet(
        f"{folder}/lineitem.parquet")


def test_stored_log_gives_the_same_splits(spark, tmp_path):
    from rankfold.plans.catalog import phases, stored_phases
    _tables(spark, tmp_path)
    cols = ["visitorid", "itemid", "event", "timestamp"]
    want, got = phases(spark, str(tmp_path)), stored_phases(spark, str(tmp_path))
    for ph in want:
        for split in SPLITS:
            a, b = (sorted(map(str, getattr(x[ph], split).select(cols).collect())) for x in (want, got))
            assert a == b and (a or split == "eval_cold")


def test_stored_log_is_not_joined_again(spark, tmp_path):
    from rankfold.plans.catalog import stored_phases
    _tables(spark, tmp_path)
    for sp in stored_phases(spark, str(tmp_path)).values():
        plan = sp.eval_warm._jdf.queryExecution().optimizedPlan().toString()
        assert "o_orderkey" not in plan and "l_orderkey" not in plan


def test_dictionary_store_reads_a_log_joined_once(spark, tmp_path, monkeypatch):
    """The dictionaries of both phases are fit on the stored log, not on a join per dictionary."""
    from rankfold.plans import catalog
    _tables(spark, tmp_path)
    joins, read = [], catalog.tpch_events
    monkeypatch.setattr(catalog, "tpch_events", lambda *a: joins.append(a) or read(*a))
    rows = {(r["phase"], r["scope"], r["field"]): r["n"] for r in catalog.q_dict_store_roundtrip(spark, str(tmp_path)).collect()}
    plan = catalog.phases(spark, str(tmp_path))["final"].train
    assert rows["final", "warm", "visitorid"] == plan.where("visitorid IS NOT NULL").select("visitorid").distinct().count()
    assert len(joins) == 1 + len(catalog.PHASES)             # the last ones are this test's own
