"""The visitor-list source and the recommendation CSV sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RECS_SCHEMA


def read_visitors(spark: SparkSession, path: str) -> DataFrame:
    """One visitor id per line; blank lines skipped."""
    v = spark.read.text(path).select(F.trim("value").alias("v"))
    return v.filter(F.length("v") > 0).select(F.col("v").cast("long").alias("visitorid"))


def parse_visitor_list(text: Column) -> Column:
    """Comma form '123, 456' -> array<long> (explode it for a table)."""
    return F.transform(F.filter(F.split(text, ","), lambda s: F.length(F.trim(s)) > 0),
                       lambda s: F.trim(s).cast("long"))


def write_visitors(visitors: DataFrame, path: str) -> str:
    visitors.select(F.col("visitorid").cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def write_recommendations(recs: DataFrame, path: str) -> str:
    """CSV with header (visitorid, rank, itemid), rank from 1, sorted within files."""
    (recs.select("visitorid", "rank", "itemid").sortWithinPartitions("visitorid", "rank")
     .write.mode("overwrite").option("header", True).csv(path))
    return path


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECS_SCHEMA).option("header", True).csv(path)
