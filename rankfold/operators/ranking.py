"""Global dense ranking without a single-partition window.

distinct rows -> range partition on the sort key -> sort inside partitions ->
monotonically_increasing_id (partition id in the high bits, position in the
low 33 bits) -> per-partition row counts -> running offsets over at most
#partitions rows -> idx = offset + position.  The numbered table is written to
the shared checkpoint folder first, so both uses see the same numbering even
if an executor is lost and a stage is recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_POS_BITS = 33


def global_index(df: DataFrame, order: list[Column], idx_col: str = "idx",
                 num_partitions: int | None = None) -> DataFrame:
    """Attach a 0-based position in ``order`` (which must be a total order over ``df``)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = (df.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id())
                .withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
                .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
                .drop("_mid")
                .checkpoint(eager=True))
    # one row per partition: bounded by n, so broadcasting it is safe
    offsets = (numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_off", F.coalesce(
                   F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
               .select("_pid", "_off"))
    return (numbered.join(F.broadcast(offsets), "_pid")
            .withColumn(idx_col, (F.col("_off") + F.col("_pos")).cast("long"))
            .drop("_pid", "_pos", "_off"))
