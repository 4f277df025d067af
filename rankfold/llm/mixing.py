"""Mixing sources to target weights by Poisson replication.

Source s with size n_s and target weight w_s gets the mean repetition rate
lambda_s = w_s * T / n_s, T being the size of the mix.  A document's number of
copies is the quantile of Poisson(lambda_s) at a uniform number hashed from its
id and the seed, so it depends on no other document and is the same in every
run; expected sizes per source are exactly w_s * T.  Copies are shuffled
globally: each goes to a partition, and to a place in it, by a hash of its own.

Size is characters + 1, so sources of empty texts are finite too.  Quantile
tables cover a window around the rate, so they grow with its square root; they
are broadcast only if all of them together take TABLE_BYTES or less, else
documents are joined to them with salted keys (a source may hold a third of all
rows).

Edge cases: a null source is a source of its own; null text counts as empty; a
source without weight, or weight 0, gets no copies; repeated rows draw the same
number each; a very long text is one document like any other, its copies are
whole; an empty table gives no rows; extra columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import h
from .common import packed

SEED = 5
#: Default weights: share of a source in proportion to its size to this power.
TEMPERATURE = 0.5
SALTS = 64


def rates(docs: DataFrame, weights: DataFrame | None = None, temperature: float = TEMPERATURE,
          total: float | None = None, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per source: (source, n_docs, size, weight, rate); ``weights`` has (source, weight)."""
    size = F.coalesce(F.char_length(text_col), F.lit(0)).cast("long") + 1
    per = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(size).alias("size"))
    if weights is None:
        per = per.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        w = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("_w"))
        per = (per.join(w, per["source"].eqNullSafe(w["_s"]), "left")
               .withColumn("weight", F.coalesce("_w", F.lit(0.0))).drop("_s", "_w"))
    sums = per.agg(F.sum("weight").alias("_ws"), F.sum("size").alias("_ts"))
    ws, ts = sums.first()                       # two numbers
    t = float(total if total is not None else ts or 0)
    return per.select("source", "n_docs", "size", (F.col("weight") / F.lit(float(ws or 1.0))).alias("weight")) \
        .withColumn("rate", F.col("weight") * F.lit(t) / F.col("size"))


#: A quantile table covers the rate and this many standard deviations and steps to both sides; what lies
#: outside has a probability below 2^-90, and draws have 60 bits.
SPREAD, MARGIN = 12, 40
#: Tables of up to this many bytes in all are broadcast.
TABLE_BYTES = 16 << 20
#: Steps of the binary search: tables of up to 2^27 entries, rates beyond 10^13.
BITS = 27


def _ln_factorial(n):
    """ln n! by Stirling's series at n + 16, where it is exact to double precision, and 16 logarithms back."""
    m = n + 16.0
    series = (m * F.ln(m) - m + 0.5 * F.ln(2 * math.pi * m) + 1 / (12 * m) - 1 / (360 * F.pow(m, F.lit(3.0)))
              + 1 / (1260 * F.pow(m, F.lit(5.0))))
    for j in range(1, 17):
        series = series - F.ln(n + float(j))
    return series


def quantile_tables(per: DataFrame) -> DataFrame:
    """(source, low, cdf) of every source of positive rate: cdf[j] = P(N <= low + j) in a window around the rate.

    One row per (source, k) is made, summed in order of k, and collected per
    source: work and size grow with the square root of the rate.
    """
    rate = F.col("rate")
    reach = SPREAD * F.sqrt(rate) + MARGIN
    low = F.greatest(F.lit(0), F.floor(rate - reach)).cast("long")
    ks = per.where("rate > 0").select("source", "rate", low.alias("low"),
                                      F.explode(F.sequence(low, F.ceil(rate + reach).cast("long"))).alias("k"))
    k = F.col("k").cast("double")
    mass = ks.select("source", "low", "k", F.exp(k * F.ln(rate) - rate - _ln_factorial(k)).alias("p"))
    one = Window.partitionBy("source", "low")
    cum = F.sum("p").over(one.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("p").over(one)
    return (mass.select("source", "low", "k", cum.alias("c")).groupBy("source", "low")
            .agg(F.sort_array(F.collect_list(F.struct("k", "c"))).alias("_t"))
            .select("source", "low", F.transform("_t", lambda t: t["c"]).alias("cdf")))


def _at_most(cdf, u):
    """Entries of rising ``cdf`` that are at most ``u``, by binary search."""
    def step(n, bit):
        ahead = n + bit
        return F.when((ahead <= F.size(cdf)) & (F.get(cdf, ahead - 1) <= u), ahead).otherwise(n)
    return F.aggregate(F.array(*[F.lit(1 << b) for b in range(BITS - 1, -1, -1)]), F.lit(0), step)


def poisson_mix(docs: DataFrame, weights: DataFrame | None = None, temperature: float = TEMPERATURE,
                total: float | None = None, seed: int = SEED, id_col: str = "doc_id",
                source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Copies of the documents: (_row, doc_id, source, copy, copies, shuffle_key), globally shuffled."""
    per = rates(docs, weights, temperature, total, source_col, text_col)
    tables = quantile_tables(per).withColumnRenamed("source", "_src").checkpoint()
    size = tables.agg(F.sum(F.size("cdf")).alias("n")).first()["n"] or 0
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = packed(docs, doc_id=F.col(id_col), source=F.col(source_col),
                  _rid=F.monotonically_increasing_id(),
                  _u=h(F.lit("mix"), ident, seed=seed) / F.lit(float(1 << 60)),
                  _id=ident)
    if 8 * size <= TABLE_BYTES:
        hit = rows.join(F.broadcast(tables), F.col("source").eqNullSafe(F.col("_src")))
    else:
        salted = tables.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hit = (rows.withColumn("_salt_r", F.pmod("_rid", F.lit(SALTS)).cast("int"))
               .join(salted, F.col("source").eqNullSafe(F.col("_src")) & (F.col("_salt_r") == F.col("_salt")))
               .drop("_salt", "_salt_r"))
    copies = F.col("low") + _at_most(F.col("cdf"), F.col("_u"))
    out = (hit.withColumn("copies", copies.cast("long")).drop("cdf", "low", "_src").where("copies > 0")
           .withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))
           .withColumn("shuffle_key", h(F.lit("place"), F.col("_id"), F.col("copy"), seed=seed)))
    # repeated rows share a shuffle key; the row id spreads them too
    return (out.repartition(F.col("shuffle_key"), F.xxhash64("shuffle_key", "_rid"))
            .sortWithinPartitions("shuffle_key")
            .select("_row", "doc_id", "source", "copy", "copies", "shuffle_key"))


def oracle(seed: int = SEED, temperature: float = TEMPERATURE) -> str:
    def hh(*parts: str) -> str:
        joined = " || '|' || ".join([*parts, f"'{seed}'"])
        return f"('0x' || substr(md5({joined}), 1, 15))::BIGINT"
    return f"""WITH per AS (SELECT source, sum(coalesce(length(text), 0) + 1)::DOUBLE AS size,
        pow(sum(coalesce(length(text), 0) + 1)::DOUBLE, {temperature}) AS w FROM documents GROUP BY source),
    rate AS (SELECT source, w / (SELECT sum(w) FROM per) * (SELECT sum(size) FROM per) / size AS r FROM per),
    lo AS (SELECT source, r, greatest(0, floor(r - {SPREAD} * sqrt(r) - {MARGIN}))::BIGINT AS low,
        ceil(r + {SPREAD} * sqrt(r) + {MARGIN})::BIGINT AS high FROM rate WHERE r > 0),
    ks AS (SELECT source, r, low, unnest(range(low, high + 1)) AS k FROM lo),
    pk AS (SELECT source, low, k, exp(k * ln(r) - r - lgamma(k + 1)) AS p FROM ks),
    cdf AS (SELECT source, low, k, sum(p) OVER (PARTITION BY source ORDER BY k) / sum(p) OVER (PARTITION BY source) AS c FROM pk),
    tbl AS (SELECT source, low, list(c ORDER BY k) AS cdf FROM cdf GROUP BY source, low),
    n AS (SELECT d.doc_id, d.source, d.text, t.low + len(list_filter(t.cdf, lambda c: c <=
        {hh("'mix'", "coalesce(d.doc_id::VARCHAR, '')")} / {float(1 << 60)!r}))::BIGINT AS copies
        FROM documents d JOIN tbl t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, source, copy, copies, {hh("'place'", "coalesce(doc_id::VARCHAR, '')", "copy::VARCHAR")} AS shuffle_key, text
    FROM (SELECT *, unnest(range(0, copies))::INTEGER AS copy FROM n)"""
