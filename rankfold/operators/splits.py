"""Chronological periods and warm / cold / full evaluation splits."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the reference log's three periods (inclusive bounds)
REFERENCE_PERIODS = {
    "p1": ("2015-05-03", "2015-06-18"),
    "p2": ("2015-06-19", "2015-07-31"),
    "p3": ("2015-08-01", "2015-09-18"),
}

# the same three roles on the TPC-H-shaped fixture (orders span 1995..2001-08-01)
FIXTURE_PERIODS = {
    "p1": ("1995-01-01", "1996-02-29"),
    "p2": ("1996-03-01", "1997-12-31"),
    "p3": ("1998-01-01", "2001-08-01"),
}

# phase -> (training period, evaluation period); Period 2 is both valid and train
PHASES = {"tune": ("p1", "p2"), "final": ("p2", "p3")}

# reference split names per phase: (train, eval_warm, eval_cold, eval_full)
SPLIT_NAMES = {
    "tune": ("train_val", "validation_warm", "validation_cold", "validation_full"),
    "final": ("train", "test_warm", "test_cold", "test_full"),
}

_MS_PER_DAY = 86_400_000


def _epoch_ms(day: str) -> int:
    d = dt.date.fromisoformat(day)
    return (d - dt.date(1970, 1, 1)).days * _MS_PER_DAY


def period_bounds(phase: str, periods: dict | None = None) -> tuple[str, str]:
    """First and last day that a phase reads: its training and its evaluation period."""
    periods = periods or FIXTURE_PERIODS
    days = [d for name in PHASES[phase] for d in periods[name]]
    return min(days), max(days)


def period_range(start: str, end: str) -> tuple[int, int]:
    """[first, last) epoch milliseconds of the days ``start`` to ``end``, both inclusive."""
    return _epoch_ms(start), _epoch_ms(end) + _MS_PER_DAY


def period(events: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose UTC date lies in [start, end], both inclusive.

    Written as a range on the epoch-ms column so it reaches a Parquet scan.
    """
    lo, hi = period_range(start, end)
    return events.filter((F.col("timestamp") >= F.lit(lo)) & (F.col("timestamp") < F.lit(hi)))


def warm(eval_df: DataFrame, train: DataFrame) -> DataFrame:
    """Eval rows whose user AND item occur in training."""
    users = train.select("visitorid").distinct()
    items = train.select("itemid").distinct()
    return eval_df.join(users, "visitorid", "left_semi").join(items, "itemid", "left_semi")


def cold(eval_df: DataFrame, train: DataFrame) -> DataFrame:
    """Eval rows whose user never occurs in training (item free)."""
    return eval_df.join(train.select("visitorid").distinct(), "visitorid", "left_anti")


@dataclass
class PhaseSplits:
    phase: str
    train: DataFrame
    eval_full: DataFrame
    eval_warm: DataFrame
    eval_cold: DataFrame

    def named(self) -> dict[str, DataFrame]:
        n_train, n_warm, n_cold, n_full = SPLIT_NAMES[self.phase]
        return {n_train: self.train, n_warm: self.eval_warm, n_cold: self.eval_cold, n_full: self.eval_full}


def build_phase(events: DataFrame, phase: str, periods: dict | None = None) -> PhaseSplits:
    periods = periods or FIXTURE_PERIODS
    tr, ev = PHASES[phase]
    train = period(events, *periods[tr])
    full = period(events, *periods[ev])
    return PhaseSplits(phase, train, full, warm(full, train), cold(full, train))


def build_splits(events: DataFrame, periods: dict | None = None) -> dict[str, DataFrame]:
    """The eight named splits."""
    out: dict[str, DataFrame] = {}
    for ph in ("tune", "final"):
        out.update(build_phase(events, ph, periods).named())
    return out


def tagged_splits(events: DataFrame, periods: dict | None = None) -> DataFrame:
    """All eight splits in one long table with a ``split`` column."""
    parts = [df.withColumn("split", F.lit(name)) for name, df in build_splits(events, periods).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
