"""Dense 0-based ID dictionaries, encode and decode joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep
from .ranking import global_index
from .splits import PhaseSplits


def fit_dictionary(*frames: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of ``col`` over all frames -> (raw, idx).

    Same as ``dense_rank() - 1`` but never funnels the data through one task.
    """
    values = frames[0].select(F.col(col).alias("raw"))
    for f in frames[1:]:
        values = values.unionByName(f.select(F.col(col).alias("raw")))
    values = values.filter(F.col("raw").isNotNull()).distinct()
    return global_index(values, [F.col("raw").asc()], "idx")


def fit_dictionaries(specs: dict[str, tuple[list[DataFrame], str]]) -> dict[str, DataFrame]:
    """Several ID dictionaries in one global ranking.

    specs: name -> (frames, column).  All values are ranked once in (name, raw)
    order; each dictionary's index is the global position minus the position
    of its first value (one row per dictionary, broadcast).
    """
    values = None
    for name, (frames, col) in specs.items():
        for f in frames:
            part = f.select(F.lit(name).alias("dict"), F.col(col).cast("long").alias("raw"))
            values = part if values is None else values.unionByName(part)
    values = values.filter(F.col("raw").isNotNull()).distinct()
    ranked = global_index(values, [F.col("dict").asc(), F.col("raw").asc()], "_g")
    starts = ranked.groupBy("dict").agg(F.min("_g").alias("_g0"))
    # every matrix encodes through these: keep the (compact) result once
    out = keep(ranked.join(F.broadcast(starts), "dict")
               .select("dict", "raw", (F.col("_g") - F.col("_g0")).alias("idx")))
    return {name: out.filter(F.col("dict") == name).select("raw", "idx") for name in specs}


def event_dictionary(events: DataFrame) -> DataFrame:
    """Event labels -> alphabetical code. The vocabulary is closed (three labels after the
    source filter), so ranking its distinct values in one partition is bounded."""
    from pyspark.sql import Window
    return (events.select(F.col("event").alias("raw")).filter(F.col("raw").isNotNull()).distinct()
            .withColumn("idx", (F.dense_rank().over(Window.orderBy("raw")) - 1).cast("long")))


def _specs(sp: PhaseSplits, scope: str) -> dict:
    fit_on = [sp.train] if scope == "warm" else [sp.train, sp.eval_full]
    return {f"{sp.phase}/{scope}/visitorid": (fit_on, "visitorid"),
            f"{sp.phase}/{scope}/itemid": (fit_on, "itemid")}


def phase_dictionaries(sp: PhaseSplits, scope: str) -> dict[str, DataFrame]:
    """warm: fit on training only; full: users/items over train U eval, events on train."""
    return all_dictionaries({sp.phase: sp}, (scope,))[(sp.phase, scope)]


def all_dictionaries(splits: dict[str, PhaseSplits], scopes=("warm", "full")) -> dict:
    """{(phase, scope): {visitorid, itemid, event}} with all ID dictionaries fit in one pass."""
    specs = {}
    for sp in splits.values():
        for scope in scopes:
            specs.update(_specs(sp, scope))
    fitted = fit_dictionaries(specs)
    out = {}
    for ph, sp in splits.items():
        ev = event_dictionary(sp.train)
        for scope in scopes:
            out[(ph, scope)] = {"visitorid": fitted[f"{ph}/{scope}/visitorid"],
                                "itemid": fitted[f"{ph}/{scope}/itemid"], "event": ev}
    return out


def encode(df: DataFrame, dictionary: DataFrame, col: str, out_col: str) -> DataFrame:
    """Raw -> idx (inner join: the dictionary covers the rows it was fit on)."""
    d = dictionary.select(F.col("raw").alias(col), F.col("idx").alias(out_col))
    return df.join(d, col)


def decode(df: DataFrame, dictionary: DataFrame, idx_col: str, out_col: str) -> DataFrame:
    """Idx -> raw."""
    d = dictionary.select(F.col("idx").alias(idx_col), F.col("raw").alias(out_col))
    return df.join(d, idx_col)


def to_inner(df: DataFrame, dictionary: DataFrame, col: str, out_col: str) -> DataFrame:
    """Raw -> idx keeping unknown rows with a null index and a ``found`` flag."""
    d = dictionary.select(F.col("raw").alias(col), F.col("idx").alias(out_col))
    return df.join(d, col, "left").withColumn("found", F.col(out_col).isNotNull())
