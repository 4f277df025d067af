"""One query per operator: (spark, sf_dir) -> DataFrame over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, decontam, fim, language_model, line_dedup, mixing, neardup, quality, runs, secrets, sharding,
               token_counts, token_files)
from .common import prepare, table


def op1_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per line of every document, each document encoded once, a token counted where it starts."""
    prepare(spark)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op2_minmax_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 2-word shingles, similarity 0.8, confirmed on full sets."""
    prepare(spark)
    return neardup.link(table(spark, sf_dir, "documents"))


def op3_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand on five or more sources."""
    prepare(spark)
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, model and base line trained on six sevenths of them."""
    prepare(spark)
    return language_model.perplexity(table(spark, sf_dir, "documents"))


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents replicated to source weights proportional to size ** 0.5, whole texts, globally shuffled."""
    prepare(spark)
    mix = mixing.poisson_mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "source", "copy", "copies", "shuffle_key", F.col("_row.text").alias("text"))


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latent score, expected grade and P(good) of every document, fitted on graded labels."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors by inner product of every vector whose id is divisible by 20."""
    prepare(spark)
    return ann.search(table(spark, sf_dir, "embeddings"))


def op8_qgram_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark passages found in it (up to 8 % edits)."""
    prepare(spark)
    found = decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (~F.col("contaminated")).alias("kept"), "contaminated", "hits")


def op9_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns and Markov spans, models trained over all documents."""
    prepare(spark)
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 16 shards of a bounded-load consistent-hash ring, law ``rows``."""
    prepare(spark)
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op11_baier_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of every document (a tenth rewritten to repeat), the longest one, digests of runs and rest."""
    prepare(spark)
    found = runs.find_runs(runs.with_planted_periods(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                              (-r["period"]).alias("period"))))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
                       F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", (-F.col("b.start")).alias("start"), F.col("b.length").alias("length"),
                      (-F.col("b.period")).alias("period"),
                      F.expr("1000 * b.length div -b.period").alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")


def op12_ranked_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written in ascending order to frequency-ranked byte files and read back."""
    prepare(spark)
    folder = token_files.write_ids(table(spark, sf_dir, "documents"))
    return token_files.read_ids(spark, folder).select("doc_id", "start", F.col("n_ids").alias("n_tokens"),
                                                      F.crc32("ids").alias("ids_crc32"))


def op13_fim_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut by lines into prefix, middle and suffix, with digests of the output and the restored text."""
    prepare(spark)
    out = fim.transform(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {
    "op1_section_tokens": op1_section_tokens,
    "op2_minmax_neardup": op2_minmax_neardup,
    "op3_line_spread": op3_line_spread,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_poisson_mix": op5_poisson_mix,
    "op6_ordinal_quality": op6_ordinal_quality,
    "op7_collision_ann": op7_collision_ann,
    "op8_qgram_decontam": op8_qgram_decontam,
    "op9_markov_secrets": op9_markov_secrets,
    "op10_bounded_ring": op10_bounded_ring,
    "op11_baier_runs": op11_baier_runs,
    "op12_ranked_bytes": op12_ranked_bytes,
    "op13_fim_index": op13_fim_index,
}

ORACLE = {
    "op3_line_spread": line_dedup.oracle(),
    "op5_poisson_mix": mixing.oracle(),
    "op10_bounded_ring": sharding.oracle(),
    "op13_fim_index": fim.oracle(),
}
