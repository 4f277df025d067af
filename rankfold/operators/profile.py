"""Profiling of the raw event log, all as single-pass aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import KNOWN_EVENTS


def shape(df: DataFrame) -> DataFrame:
    """A1: rows, columns, and the type of every column (one row per column)."""
    n_rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    spark = df.sparkSession
    types = spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(df.dtypes)],
                                  "position int, column_name string, data_type string")
    rows_per_col = n_rows.select(F.explode(F.array(*[F.lit(i) for i in range(len(df.columns))])).alias("position"),
                                 "n_rows")
    return types.join(rows_per_col, "position").withColumn("n_columns", F.lit(len(df.columns)))


def null_counts(df: DataFrame) -> DataFrame:
    """A2: missing values per column in one pass, unpivoted to (column_name, n_null)."""
    agg = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    return agg.unpivot([], df.columns, "column_name", "n_null")


def event_counts(df: DataFrame) -> DataFrame:
    """A3: rows per event label with its share in percent (null labels dropped)."""
    c = df.filter(F.col("event").isNotNull()).groupBy("event").agg(F.count(F.lit(1)).alias("n"))
    total = df.filter(F.col("event").isNotNull()).count()        # labels of a raw log are not a closed set: no window
    return c.select("event", "n", F.round(F.col("n") * 100.0 / F.lit(total), 6).alias("share_pct"),
                    F.col("event").isin(*KNOWN_EVENTS).alias("known"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """A4: full-row duplicates (null-safe: grouping treats nulls as equal)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
                 F.count(F.when(F.col("n") > 1, 1)).alias("duplicated_keys"))


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    """A5: distinct visitors and items (exact by default)."""
    fn = F.approx_count_distinct if approx else F.countDistinct
    return df.agg(fn("visitorid").alias("n_visitors"), fn("itemid").alias("n_items"),
                  F.count(F.lit(1)).alias("n_events"))


def daily_event_counts(df: DataFrame) -> DataFrame:
    """Rows per (date, event)."""
    return (df.filter(F.col("event").isNotNull() & F.col("date").isNotNull())
            .groupBy("date", "event").agg(F.count(F.lit(1)).alias("count")))


def top_items_per_event(df: DataFrame, n: int | None = None) -> DataFrame:
    """Count per (event, itemid); with ``n``, the n most frequent items of each event."""
    c = (df.filter(F.col("event").isNotNull() & F.col("itemid").isNotNull())
         .groupBy("event", "itemid").agg(F.count(F.lit(1)).alias("count")))
    if n is None:
        return c
    w = Window.partitionBy("event").orderBy(F.col("count").desc(), F.col("itemid").asc())
    return c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def top_items_head(df: DataFrame, n: int = 10) -> DataFrame:
    """A7 as printed: first n rows in (event asc, count desc, itemid asc) order."""
    return (top_items_per_event(df).orderBy(F.col("event").asc(), F.col("count").desc(), F.col("itemid").asc())
            .limit(n))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """head(n) with the order made explicit."""
    return df.orderBy("timestamp", "visitorid", "itemid", "event").limit(n)


def profile_summary(raw: DataFrame) -> DataFrame:
    """The findings table from one pass over the log.

    Full rows are counted first; each distinct row then adds its counts to its
    visitor and to its item, and the totals are sums over the items (the null
    item included).  Three aggregations in one job, nothing is kept.
    """
    rows = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")

    def when(condition):
        return F.sum(F.when(condition, n).otherwise(0))
    known = F.coalesce(F.col("event").isin(*KNOWN_EVENTS), F.lit(False))
    sides = F.explode(F.array(F.struct(F.lit("v").alias("side"), F.col("visitorid").alias("id")),
                              F.struct(F.lit("i").alias("side"), F.col("itemid").alias("id")))).alias("_s")
    per = rows.select("event", "transactionid", "n", sides).groupBy("_s.side", "_s.id").agg(
        F.sum(n).alias("n"), F.sum(n - 1).alias("repeated"), when(~known).alias("unknown"),
        when(F.col("event").isNotNull()).alias("labelled"), when(F.col("transactionid").isNull()).alias("untransacted"),
        *[when(F.col("event") == e).alias(e) for e in KNOWN_EVENTS])
    item, known_id = F.col("side") == "i", F.col("id").isNotNull()
    signal = F.col("addtocart") + F.col("transaction")

    def total(c):
        return F.coalesce(F.sum(F.when(item, F.col(c))), F.lit(0)).cast("long")

    def share(event):
        return F.round(F.sum(F.when(item, F.col(event))) / F.sum(F.when(item, F.col("labelled"))) * 100, 6).alias(f"{event}_pct")
    return per.agg(
        total("n").alias("n_events"), F.count(F.when(~item & known_id, 1)).alias("n_visitors"),
        F.count(F.when(item & known_id, 1)).alias("n_items"), share("view"), share("addtocart"), share("transaction"),
        total("unknown").alias("unknown_events"), total("untransacted").alias("null_transactionid"),
        total("repeated").alias("duplicate_rows"),
        F.min_by("id", F.when(item & known_id & (signal > 0), F.struct((-signal).alias("n"), F.col("id")))).alias("top_item"))
