"""Time features from epoch milliseconds (UTC), independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MS_PER_DAY = 86_400_000


def epoch_days(ms: Column) -> Column:
    return F.floor(ms / F.lit(_MS_PER_DAY)).cast("int")


def utc_date(ms: Column) -> Column:
    return F.date_from_unix_date(epoch_days(ms))


def utc_hour(ms: Column) -> Column:
    return F.floor(F.pmod(ms, F.lit(_MS_PER_DAY)) / F.lit(3_600_000)).cast("int")


def day_of_week_mon0(ms: Column) -> Column:
    # 1970-01-01 was a Thursday (3 when Monday = 0)
    return F.pmod(epoch_days(ms) + F.lit(3), F.lit(7)).cast("int")


def utc_datetime(ms: Column) -> Column:
    """Naive UTC wall-clock timestamp (TIMESTAMP_NTZ), whatever the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit("UTC"), F.timestamp_millis(ms))


def ntz_to_epoch_ms(ts: Column) -> Column:
    """Epoch ms of a naive (UTC) timestamp, without going through the session zone."""
    return (F.unix_date(F.to_date(ts)).cast("long") * F.lit(_MS_PER_DAY)
            + F.hour(ts).cast("long") * F.lit(3_600_000)
            + F.minute(ts).cast("long") * F.lit(60_000)
            + F.floor(F.date_part(F.lit("SECOND"), ts) * F.lit(1000)).cast("long"))


def with_time_features(events: DataFrame, ms_col: str = "timestamp") -> DataFrame:
    """Datetime, date, hour, day_of_week (Mon=0), is_weekend."""
    ms = F.col(ms_col)
    dow = day_of_week_mon0(ms)
    return events.withColumns({
        "date": utc_date(ms),
        "datetime": utc_datetime(ms),
        "hour": utc_hour(ms),
        "day_of_week": dow,
        "is_weekend": dow.isin(5, 6),
    })
