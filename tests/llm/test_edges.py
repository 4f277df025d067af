"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rankfold.llm import (ann, decontam, language_model, line_dedup, mixing, neardup, quality, secrets, sharding,
                          token_counts)
from rankfold.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 997} and{i % 31}" for i in range(40_000))
ROWS = [
    (1, "one two three four five six seven", "en", "a", 1), (1, "one two three four five six seven", "en", "a", 1),
    (2, "ONE two three four five six seven", "en", "b", 1), (3, None, "en", None, None), (4, "", None, "a", 0),
    (5, " \n\t ", "en", "a", 3), (None, "no id here at all", "en", "a", 9), (None, None, None, None, None),
    (7, "x", "en", "c", 1), (8, LONG, "en", "a", len(LONG)), (9, "\U0001F600 é token=\"abcdef123\" ü", "en", "a", 9),
]
CLASH = ["shard", "slot", "size", "law", "kept", "score", "copy", "copies", "hits_0", "_row", "a", "b", "v", "n", "grade",
         "component_id", "contaminated", "_t", "_rid", "rank", "arc", "shuffle_key", "text_crc32"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return stored(df.withColumns({c: F.lit("extra") for c in CLASH}), "edge")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("1 = 0")


def by_id(rows, col="doc_id"):
    out = {}
    for r in rows:
        out.setdefault(r[col], []).append(r)
    return out


def test_token_counts(docs, empty):
    rows = by_id(token_counts.count_tokens(docs).collect())
    assert len(rows[1]) == 2 and rows[1][0] == rows[1][1]
    for i in (3, 4):
        assert [(r.section, r.n_tokens, r.last_char) for r in rows[i]] == [(0, 0, 0)]
    assert len(rows[None]) == 2
    assert sum(r.n_tokens for r in rows[8]) == rows[8][0].doc_tokens > 40_000
    assert token_counts.count_tokens(empty).collect() == []


def test_near_duplicates(docs, empty):
    rows = by_id(neardup.link(docs).collect())
    assert [r.component_id for r in rows[1]] == [1, 1] and rows[2][0].component_id == 1 and not rows[2][0].kept
    for i in (3, 4, 5):
        assert (rows[i][0].n_shingles, rows[i][0].component_id, rows[i][0].kept) == (0, i, True)
    assert all(r.component_id is None and r.kept for r in rows[None])
    assert rows[7][0].n_shingles == 1
    assert neardup.link(empty).collect() == []


def test_line_dedup(docs, empty):
    rows = by_id(line_dedup.drop_boilerplate(docs, min_sites=2).collect())
    assert (rows[3][0].n_lines, rows[3][0].text) == (0, None)
    assert (rows[4][0].n_lines, rows[4][0].text) == (1, "") and rows[5][0].n_removed == 0
    assert len(rows[1]) == 2 and len(rows[None]) == 2 and rows[8][0].text == LONG
    assert line_dedup.drop_boilerplate(empty).collect() == []


def test_language_model(docs, empty):
    rows = by_id(language_model.perplexity(docs).collect())
    assert rows[3][0].n_tokens == rows[4][0].n_tokens == rows[5][0].n_tokens == 1
    assert rows[1][0] == rows[1][1] and rows[8][0].n_tokens == 80_001
    assert all(r.score < 0 and r.train_tokens == rows[1][0].train_tokens for rs in rows.values() for r in rs)
    assert language_model.perplexity(empty).collect() == []
    only = language_model.perplexity(docs.where("doc_id = 1 AND 1 = 0").unionByName(docs.where("doc_id IS NULL"))).collect()
    assert len(only) == 2


def test_mixing(docs, empty):
    rows = mixing.poisson_mix(docs, total=4e5).collect()
    assert {r.doc_id for r in rows} <= {1, 2, 3, 4, 5, 7, 8, 9, None}
    for i, rs in by_id(rows).items():
        assert len(rs) == sum({(r.copies, id(r)) : 1 for r in rs}.values())
    one = by_id(rows).get(1, [])
    assert len(one) % 2 == 0                                  # the repeated row draws the same number twice
    assert mixing.poisson_mix(empty).collect() == []
    none = mixing.poisson_mix(docs, docs.sparkSession.createDataFrame([("a", 0.0)], "source string, weight double"))
    assert none.collect() == []


def test_quality(docs, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (8, None, 1), (77, 1, 0), (None, 1, 1), (7, None, None)],
                                   "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    assert model is not None and len(quality.score(docs, model).collect()) == len(ROWS)
    assert quality.train(docs, labels.where("1 = 0")) is None
    assert all(r.kept and r.p_keep == 1 for r in quality.score(docs, None).collect())
    assert quality.score(empty, model).collect() == []


def test_ann(spark):
    v = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]),
         (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, []), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (40, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    rows = by_id(ann.search(df).orderBy("rank").collect(), "query_id")
    assert [(r.rank, r.vec_id, r.score) for r in rows[0]] == [(1, 1, 1.0), (2, 2, 1.0), (3, 20, 0.0)]
    assert [(r.vec_id, r.score) for r in rows[20]] == [(0, 0.0), (1, 0.0), (2, 0.0)]
    assert [(r.vec_id, r.score) for r in rows[40]] == [(9, 6.0)]
    assert ann.search(df.where("1 = 0")).collect() == []


def test_ann_repeated_ids(spark):
    a, b, c = [1.0, 0, 0, 0], [0, 1.0, 0, 0], [0, 0, 1.0, 0]
    rows = [(20, a)] * 300 + [(3, [0.9, 0, 0, 0])] * 25                     # more rows of the query's own id than LEAST
    rows += [(40, b)] + [(101 + i // 2, [0, 0.9 - i // 2 / 100, 0, 0]) for i in range(20)]
    rows += [(60, c), (60, [0, 0, 0, 1.0]), (7, [0, 0, 0.5, 0.6])]          # a query id with two vectors
    rows += [(1001 + 20 * i, [-0.1, -0.1, -0.1, -0.1 - i / 1e4]) for i in range(400)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<float>")
    got = by_id(ann.search(df).orderBy("rank").collect(), "query_id")
    assert set(got) == {20, 40, 60}
    assert [(r.rank, r.vec_id) for r in got[20]] == [(n, 3) for n in range(1, 21)]
    assert [(r.rank, r.vec_id) for r in got[40]] == [(n + 1, 101 + n // 2) for n in range(20)]
    assert (got[60][0].vec_id, round(got[60][0].score, 6)) == (7, 0.6) and len(got[60]) == 20
    assert sum(r.vec_id == 7 for r in got[60]) == 1


def test_decontamination(docs, empty, spark):
    bench = spark.createDataFrame([(1, "two THREE  four\nfive six"), (2, None), (None, "x"), (3, "x"), (4, " "),
                                   (5, "two THREE  four\nfive six")], "item_id long, text string")
    rows = by_id(decontam.scan(docs, bench).collect())
    assert [h.item_id for h in rows[1][0].hits] == [1, 3, 5] and rows[2][0].contaminated      # 3: the x of "six"
    assert [h.item_id for h in rows[7][0].hits] == [3]
    assert not any(rows[i][0].contaminated for i in (3, 4, 5, 8, 9, None))
    assert not any(r.contaminated for r in decontam.scan(docs, bench.where("1 = 0")).collect())
    assert decontam.scan(empty, bench).collect() == []


def test_secrets(docs, empty):
    rows = by_id(secrets.scan(docs).collect())
    assert rows[9][0].n_assign == 1 and rows[9][0].spans.startswith("assign:4:")     # code points, not UTF-16 units
    assert rows[3][0].spans == "" and len(rows[1]) == 2
    assert secrets.scan(empty).collect() == []


def test_sharding(docs, empty):
    rows = sharding.assign_shards(docs, shards=4).collect()
    count = [sum(r.shard == s for r in rows) for s in range(4)]
    assert sum(count) == len(ROWS) and max(count) - min(count) <= 1
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(count[s]))
    assert by_id(rows)[3][0].size == 1 and by_id(rows)[3][0].text_crc32 == 0
    assert sharding.assign_shards(empty).collect() == []


def test_pipeline_stages(docs, empty, spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "two three four five six")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    for start in (docs, empty):
        df = start
        for name, stage in corpus_pipeline.STAGES:
            df = stored(stage(spark, df, str(tmp_path)), f"edge-{name}")
            if name != "sharding":
                assert df.columns == start.columns
        assert df.columns[:len(start.columns)] == start.columns and "ring_shard" in df.columns
    kept = stored(corpus_pipeline.near_duplicate_stage(spark, docs, str(tmp_path)), "edge-kept").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 3, 4, 5, 7, 8, 9]
    assert sum(r.doc_id is None for r in kept) == 2
