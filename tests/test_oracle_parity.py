"""Catalog queries against their DuckDB oracle on the smallest fixture."""

import pytest

from tools.oracle_check import digest

FAST = [
    "src_events", "time_features", "split_warm", "split_cold", "split_summary", "id_dictionary",
    "id_dictionary_full", "event_codes", "interaction_matrix", "explicit_ratings", "rating_stats",
    "most_active_user", "popular_pool", "popular_topk", "popular_precision", "profile_summary",
    "profile_nulls", "event_counts", "score_topk", "recs_svd_topn", "recs_batch", "svd_predict",
    "precision_recall_mf", "borda_points", "borda_with_hits", "ensemble_precision",
    "runs_log_training", "runs_log_tuning", "bucketed_decode", "ensemble_precision_sampled", "als_foldin",
]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as entry
    from conftest import SF_SMALL
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_every_oracle_key_is_a_query():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    rows = entry.entry(spark).collect()
    assert len(rows) == 2
    assert all(0.0 <= r["mean_precision"] <= 1.0 for r in rows)
