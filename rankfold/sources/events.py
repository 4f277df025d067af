"""Event-log sources, plus the two fixture views over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefeat import ntz_to_epoch_ms, with_time_features
from ..schemas import ENRICHED_COLUMNS, EVENT_SCHEMA, KNOWN_EVENTS


def known_events_only(events: DataFrame) -> DataFrame:
    """Unknown event labels are dropped at the source (counted by the profile)."""
    return events.filter(F.col("event").isin(*KNOWN_EVENTS))


def read_raw_events(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The raw log with its fixed schema: CSV with header, or Parquet.

    CSV columns are taken by the names in the header, whatever their order; a
    column that is missing is an error, further columns are ignored.
    """
    if fmt == "csv":
        raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
        missing = [f.name for f in EVENT_SCHEMA if f.name not in raw.columns]
        if missing:
            raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
        return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA])
    return spark.read.schema(EVENT_SCHEMA).format(fmt).load(path)


def enrich(raw: DataFrame) -> DataFrame:
    """P1 + P2: time features and the 10 working columns."""
    return with_time_features(known_events_only(raw)).select(*ENRICHED_COLUMNS)


def read_events(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return enrich(read_raw_events(spark, path, fmt))


def tpch_raw_events(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Main fixture: lineitem joined to its order, read as a click log.

    ``days`` (first, last) bounds the order date, as a filter that reaches the scan.

    visitor = customer, item = part, return flag N/A/R = view/addtocart/transaction,
    time = order date, transaction id = order key on purchases.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_returnflag")
    od = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    if days is not None:
        day = F.col("o_orderdate")
        od = od.filter((day >= F.lit(days[0]).cast("timestamp_ntz"))
                       & (day < F.lit(days[1]).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")))
    joined = li.join(od, li.l_orderkey == od.o_orderkey)
    event = (F.when(F.col("l_returnflag") == "N", "view")
             .when(F.col("l_returnflag") == "A", "addtocart")
             .otherwise("transaction"))
    return joined.select(
        F.col("o_custkey").alias("visitorid"),
        ntz_to_epoch_ms(F.col("o_orderdate")).alias("timestamp"),
        event.alias("event"),
        F.col("l_partkey").alias("itemid"),
        F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("transactionid"),
    )


def tpch_events(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    return enrich(tpch_raw_events(spark, sf_dir, days))


def click_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second fixture: the driver's ``events`` table, which carries time of day.

    error / signup rows keep their label here and are dropped by ``enrich``.
    """
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "props")
    event = (F.when(F.col("event_type") == "view", "view")
             .when(F.col("event_type") == "click", "addtocart")
             .when(F.col("event_type") == "purchase", "transaction")
             .otherwise(F.col("event_type")))
    return ev.select(
        F.col("user_id").alias("visitorid"),
        ntz_to_epoch_ms(F.col("ts")).alias("timestamp"),
        event.alias("event"),
        F.get_json_object("props", "$.k").cast("bigint").alias("itemid"),
        F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("transactionid"),
    )


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(click_raw_events(spark, sf_dir))
