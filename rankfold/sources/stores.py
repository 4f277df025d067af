"""Ratings CSV, and the split / dictionary / interaction stores (Parquet).

Stores are partitioned by their selector columns so that reading one split,
one dictionary or one matrix is a partition-pruned scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.splits import tagged_splits
from ..schemas import RATING_SCHEMA
from ..session import scratch_path


def write_ratings(ratings: DataFrame, path: str) -> str:
    """S3: header-less CSV (user_id, item_id, rating)."""
    ratings.select("user_id", "item_id", "rating").write.mode("overwrite").option("header", False).csv(path)
    return path


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Header-less CSV with the named, typed columns."""
    return spark.read.schema(RATING_SCHEMA).option("header", False).csv(path)


def write_splits(events: DataFrame, path: str | None = None, periods: dict | None = None) -> str:
    """The eight splits in one table partitioned by ``split``, time-ordered inside files.

    Ranges of (split, time) are dealt out, so the number of writing tasks does
    not depend on the number of splits and a file holds one stretch of time.
    """
    spark = events.sparkSession
    path = path or scratch_path(spark, "splits")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (tagged_splits(events, periods)
     .repartitionByRange(n, "split", "timestamp")
     .sortWithinPartitions("split", "timestamp")
     .write.mode("overwrite").partitionBy("split").parquet(path))
    return path


def read_split(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("split") == name).drop("split")


def write_dictionaries(dicts: dict, path: str | None = None) -> str:
    """{(phase, scope): {field: (raw, idx)}} -> one table partitioned by phase/scope/field."""
    parts = []
    for (phase, scope), d in dicts.items():
        for field, df in d.items():
            parts.append(df.select(F.col("raw").cast("string").alias("raw"), "idx",
                                   F.lit(phase).alias("phase"), F.lit(scope).alias("scope"),
                                   F.lit(field).alias("field")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    spark = out.sparkSession
    path = path or scratch_path(spark, "dictionaries")
    out.write.mode("overwrite").partitionBy("phase", "scope", "field").parquet(path)
    return path


def read_dictionary(spark: SparkSession, path: str, phase: str, scope: str, field: str) -> DataFrame:
    d = (spark.read.parquet(path)
         .filter((F.col("phase") == phase) & (F.col("scope") == scope) & (F.col("field") == field))
         .select("raw", "idx"))
    if field != "event":
        d = d.withColumn("raw", F.col("raw").cast("long"))
    return d


def write_interactions(cells: DataFrame, path: str | None = None) -> str:
    """Long-form cells partitioned by (phase, scope, matrix)."""
    path = path or scratch_path(cells.sparkSession, "interactions")
    cells.write.mode("overwrite").partitionBy("phase", "scope", "matrix").parquet(path)
    return path


def read_interactions(spark: SparkSession, path: str, phase: str, scope: str, matrix: str) -> DataFrame:
    return (spark.read.parquet(path)
            .filter((F.col("phase") == phase) & (F.col("scope") == scope) & (F.col("matrix") == matrix))
            .select("user_idx", "item_idx", "weight"))


#: Buckets of a pre-partitioned store unless the caller asks for another number: raise it with the data.
BUCKETS = 64


def _register(spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> str:
    name = f"rankfold_store_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet OPTIONS (path '{path}') "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS")
    return name


def write_bucketed(df: DataFrame, key: str, buckets: int = BUCKETS, path: str | None = None) -> str:
    """A table hashed into buckets by ``key`` and sorted in them, written once.

    Tables bucketed alike are joined and grouped on their keys without a
    shuffle: dictionaries by their id, cells by their user or item.  Rows are
    dealt to their buckets first, so every bucket is one file.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "bucketed")
    name = f"rankfold_store_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key)
     .saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")            # the files stay: only the name goes
    return path


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The table behind ``path`` with its buckets known to the planner."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    return spark.table(_register(spark, path, schema, key, buckets))


def phase_from_store(spark: SparkSession, path: str, phase: str):
    """PhaseSplits read back from a split store (partition-pruned scans, no recomputation).

    On a cluster this is the intended hand-off: one job writes the store with
    ``write_splits``; every later operator starts from it instead of caching
    the whole enriched log.
    """
    from ..operators.splits import SPLIT_NAMES, PhaseSplits
    tr, wa, co, fu = SPLIT_NAMES[phase]
    return PhaseSplits(phase, read_split(spark, path, tr), read_split(spark, path, fu),
                       read_split(spark, path, wa), read_split(spark, path, co))
