"""Helpers the operators share: written tables, size-checked joins, packing of caller columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path, ship_package

#: A side is broadcast only after its rows were counted and found to be at most this many narrow rows.
BROADCAST_ROWS = 200_000


def prepare(spark: SparkSession) -> None:
    """Name the checkpoint folder and ship the package; call once per query."""
    checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows, else as it is (shuffled join)."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def packed(docs: DataFrame, **extra) -> DataFrame:
    """All columns of ``docs`` in one struct ``_row`` beside ``extra``, so that no name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       *[e.alias(n) for n, e in extra.items()])


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """The caller's columns again, in their order."""
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns])
