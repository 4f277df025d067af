"""Training-corpus pipeline over ``documents``: five stages, each one of the operators in ``rankfold.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``.  All stages but the last
return the columns of ``docs``; a stage works on everything its predecessor
kept, and its decisions take effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.llm import decontam, mixing, neardup, quality, sharding
from rankfold.llm.common import packed, prepare, small_side, stored, table, unpacked

#: Near-duplicates of the pipeline: five-word shingles, similarity 0.8.
SHINGLE = 5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is at least one half."""
    prepare(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return unpacked(quality.score(docs, model, carry=True).where("kept"), docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: its smallest id.

    Rows that share an id are one document, of which the row of smallest text
    stays; rows with a null id all stay.
    """
    prepare(spark)
    linked = neardup.link(docs, k=SHINGLE)
    gone = stored(linked.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct(), "stage-gone")
    left = docs.join(small_side(gone), docs["doc_id"] == F.col("_gone"), "left_anti")
    again = stored(docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_again")).count()
                   .where("count > 1").select("_again"), "stage-again")
    if again.isEmpty():
        return left
    again = small_side(again)
    single = left.join(again, F.col("doc_id") == F.col("_again"), "left_anti")
    repeated = left.join(again, F.col("doc_id") == F.col("_again"), "left_semi")
    rows = packed(repeated, _id=F.col("doc_id"), _key=F.struct(F.col("text"), F.to_json(F.struct("*"))))
    one = rows.groupBy("_id").agg(F.min_by("_row", "_key").alias("_row"))
    return single.unionByName(unpacked(one, docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    prepare(spark)
    found = decontam.scan(docs, table(spark, sf_dir, "benchmark"), carry=True)
    return unpacked(found.where("NOT contaminated"), docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson draws to the target weights of their sources, shuffled."""
    prepare(spark)
    return unpacked(mixing.poisson_mix(docs), docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy with its shard and slot; a column name that documents already use gets the prefix ``ring_``."""
    prepare(spark)
    placed = sharding.assign_shards(docs, carry=True)
    used = {c.lower() for c in docs.columns}
    extra = [F.col(c).alias(f"ring_{c}" if c in used else c)
             for c in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    return placed.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns], *extra)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The classifier is trained and the passages are aligned: SQL can't express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
