"""Line dedup by distinct-site spread: HyperLogLog per line hash, exact counts near the threshold.

A line repeated within one site is that site's business; a line that stands on
many sites is boilerplate.  For every hash of a trimmed non-blank line a
HyperLogLog sketch of its sites is built and merged by aggregation (map side
first), so a line on a third of all rows costs one sketch per task.  Lines
estimated within ``BAND`` of ``MIN_SITES`` get an exact distinct count from
their (line, site) pairs; lines above the band are boilerplate as estimated.
Every occurrence of a boilerplate line is removed; the other lines of a text
stay in order.

The hash is two 64-bit hashes side by side, so unlike lines do not meet.

Edge cases: a null site is a site of its own (the empty name); null text gives
null text and 0 lines; empty text is one blank line; blank lines are kept; a
text may become empty; repeated rows stay repeated; a line on exactly
``min_sites`` sites goes; very long texts are split whole; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_side, stored

MIN_SITES = 5
#: log2 of the sketch registers: relative standard error about 1.6 %.
LG_K = 12
#: Estimates within this share of the threshold (at least 2 sites) are counted exactly: over 10 standard errors.
BAND = 0.2


def _lines(docs: DataFrame, site: str, text: str) -> DataFrame:
    """One row per line: (_rid, site, pos, line, h1, h2); h1 is null for blank lines."""
    trimmed = F.trim(F.col("line"), F.lit(" \t\r"))
    ink = trimmed != ""
    rows = docs.select(F.monotonically_increasing_id().alias("_rid"), F.col("_id"),     # one id per row, before the split
                       F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
                       F.split(F.col(text), "\n", -1).alias("_lines"))
    return (rows.select("_rid", "_id", "site", F.posexplode_outer("_lines").alias("pos", "line"))
            .withColumn("h1", F.when(ink, F.xxhash64(trimmed)))
            .withColumn("h2", F.when(ink, F.xxhash64(F.lit(3), F.reverse(trimmed)))))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, site_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """Hashes (h1, h2, n_sites, exact) of the lines on at least ``min_sites`` sites."""
    lines = _lines(docs.select(F.lit(None).alias("_id"), F.col(site_col), F.col(text_col)), site_col, text_col)
    lines = lines.where("h1 is not null").select("h1", "h2", "site")
    band = max(2.0, min_sites * BAND)
    spread = (lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", LG_K).alias("sketch"))
              .withColumn("est", F.hll_sketch_estimate("sketch")).drop("sketch")
              .where(F.col("est") > min_sites - band))
    spread = stored(spread, "line-spread")
    near = spread.where(F.col("est") <= min_sites + band).select("h1", "h2")
    exact = (lines.distinct().join(small_side(near), ["h1", "h2"], "left_semi")
             .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_sites")).where(F.col("n_sites") >= min_sites)
             .withColumn("exact", F.lit(True)))
    sure = (spread.where(F.col("est") > min_sites + band)
            .select("h1", "h2", F.col("est").cast("long").alias("n_sites"), F.lit(False).alias("exact")))
    return sure.unionByName(exact)


def drop_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id",
                     site_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, text) of every document, boilerplate lines removed."""
    bad = stored(boilerplate(docs, min_sites, site_col, text_col).select("h1", "h2"), "line-bad")
    lines = _lines(docs.select(F.col(id_col).alias("_id"), F.col(site_col), F.col(text_col)), site_col, text_col)
    # blank lines have no hash: a key of their own each spreads them where the join is shuffled
    lines = lines.withColumns({"_k1": F.coalesce("h1", "_rid"), "_k2": F.coalesce("h2", F.col("pos").cast("long"))})
    bad = bad.select(F.col("h1").alias("_k1"), F.col("h2").alias("_k2"), F.lit(True).alias("_hit"))
    marked = lines.join(small_side(bad), ["_k1", "_k2"], "left")
    kept = F.struct("pos", "line")
    hit, there = F.col("_hit").isNotNull() & F.col("h1").isNotNull(), F.col("line").isNotNull()
    per = marked.groupBy("_rid").agg(
        F.first("_id").alias("doc_id"), F.count("line").alias("n_lines"),
        F.count(F.when(hit, 1)).alias("n_removed"),
        F.collect_list(F.when(there & ~hit, kept)).alias("_kept"))
    text = F.array_join(F.transform(F.array_sort("_kept"), lambda x: x["line"]), "\n")
    return per.select("doc_id", "n_lines", "n_removed", F.when(F.col("n_lines") > 0, text).alias("text"))


def oracle(min_sites: int = MIN_SITES) -> str:
    return f"""WITH l AS (SELECT rid, doc_id, coalesce(source, '') AS site, text, unnest(ls) AS line,
        unnest(range(0, len(ls))) AS pos FROM (SELECT row_number() OVER () AS rid, *, string_split(text, chr(10)) AS ls FROM documents)),
    t AS (SELECT *, trim(line, chr(32) || chr(9) || chr(13)) AS k FROM l),
    bad AS (SELECT k FROM t WHERE k <> '' GROUP BY k HAVING count(DISTINCT site) >= {min_sites})
    SELECT doc_id, count(*) AS n_lines, count(b.k) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE b.k IS NULL), '') AS text
    FROM t LEFT JOIN bad b ON t.k = b.k GROUP BY rid, doc_id
    UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL"""
