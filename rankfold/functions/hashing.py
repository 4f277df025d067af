"""Deterministic, engine-independent pseudo-randomness.

``h(parts..., seed)`` = first 15 hex digits of md5 over ``parts`` joined by
'|' with the seed last, read as a non-negative bigint.  The same expression
exists in plain SQL engines, so every sampling operator built on it can be
checked against an SQL oracle (numpy's random stream could not be).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def h(*parts, seed: int = 42) -> Column:
    joined = F.concat_ws("|", *[_as_col(p).cast("string") for p in parts], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def uniform(*parts, seed: int = 42) -> Column:
    """Uniform draw in [0, 1) with a resolution of 1e-6."""
    return (h(*parts, seed=seed) % F.lit(1000000)) / F.lit(1000000.0)


def frozen_factor(tag: str, side: str, ident, dim: int, seed: int = 42) -> Column:
    """Integer factor in [-10, 10]; exact in any engine."""
    return (h(F.lit(tag), F.lit(side), ident, F.lit(dim), seed=seed) % F.lit(21) - F.lit(10)).cast("double")


def frozen_bias(tag: str, side: str, ident, seed: int = 42) -> Column:
    """Integer bias in [-5, 5]."""
    return (h(F.lit(tag), F.lit(side), ident, F.lit("b"), seed=seed) % F.lit(11) - F.lit(5)).cast("double")
