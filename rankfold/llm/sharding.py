"""Sharding: consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring; a document's key is a hash of its
id and its home is the first point clockwise.  Loads are bounded: a shard has
room for its quota of rows, and keys that find it full go on clockwise to the
next shard that has room.

Law ``rows``: with ``slack`` 0 the quotas add up to the number of documents and
differ by at most one, so every shard ends exactly at its quota.

How it is computed.  All keys on one arc (between two ring points) walk the
same shards, so the walk is settled on arc counts, at most shards x vnodes rows
however large the corpus: round r offers each arc's remaining keys to its r-th
shard, which takes them in clockwise order while it has room.  An arc's keys in
ring order then fall into consecutive intervals, each with a shard and the
first slot there; a document finds its interval by its position on its arc.
Only narrow rows (or the rows the caller wants carried) are sorted, by range,
with a running row id as last sort key, so no key value can fill one task.

Edge cases: null or repeated ids hash like any value, equal rows are placed one
by one at neighbouring slots; null text has size 1 and crc 0; very long texts
count by their bytes and are not moved unless carried; an empty table gives no
rows; extra columns are ignored unless carried.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import h
from ..operators.ranking import global_index
from .common import packed, stored

SHARDS = 16
VNODES = 128
SEED = 10
#: Ring resolution: keys and points are read off the top bits of a 60-bit hash.
SLOT_BITS = 16
_SHIFT = 60 - SLOT_BITS


def _point(*parts, seed: int) -> int:
    text = "|".join(map(str, (*parts, seed)))
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def ring(shards: int = SHARDS, vnodes: int = VNODES, seed: int = SEED) -> list[tuple]:
    """The ring as configuration (no data): (arc, first slot, last slot, shards met clockwise).

    Arc a ends at point a; slots behind the last point wrap to arc 0, which
    therefore has two slot ranges.
    """
    points = sorted((_point("ring", s, v, seed=seed), s) for s in range(shards) for v in range(vnodes))
    ends = [p >> _SHIFT for p, _ in points]
    walks, walk = [[] for _ in points], []
    for i in range(2 * len(points) - 1, -1, -1):       # backwards, twice round: nearest shard first
        s = points[i % len(points)][1]
        walk = [s] + [x for x in walk if x != s]
        walks[i % len(points)] = walk
    rows, lo = [], 0
    for a, e in enumerate(ends):
        if e >= lo:
            rows.append((a, lo, e, walks[a]))
            lo = e + 1
    if lo < 1 << SLOT_BITS:
        rows.append((0, lo, (1 << SLOT_BITS) - 1, walks[0]))
    return rows


def _settle(arcs: DataFrame, shards: int, slack: float) -> DataFrame:
    """Intervals (arc, lo, hi, shard, base) from arcs (arc, walk, n, first): the bounded-load walk.

    ``arcs`` has at most shards x vnodes rows and is kept in one partition, so
    the rounds below are windows without any exchange.
    """
    one = arcs.coalesce(1).withColumn("total", F.sum("n").over(Window.partitionBy()))
    none = F.array().cast("array<struct<lo:bigint,hi:bigint,shard:int,base:bigint>>")
    state = one.select("arc", "first", "walk", "n", F.lit(None).cast("long").alias("cap"),
                       F.lit(0).cast("long").alias("used"), F.lit(-1).alias("s"),
                       F.lit(0).cast("long").alias("placed"), none.alias("ivs"))
    room = (one.select("total").where(F.col("arc") == 0).withColumn(
        "s", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    quota = (F.floor(F.col("total") / shards) + F.when(F.col("s") < F.col("total") % shards, 1).otherwise(0)
             if slack == 0 else F.ceil(F.col("total") * (1 + slack) / shards))
    state = state.unionByName(room.select(
        F.lit(-1).cast("long").alias("arc"), F.lit(0).cast("long").alias("first"),
        F.array().cast("array<int>").alias("walk"), F.lit(0).cast("long").alias("n"),
        quota.cast("long").alias("cap"), F.lit(0).cast("long").alias("used"), F.col("s").cast("int").alias("s"),
        F.lit(0).cast("long").alias("placed"), none.alias("ivs"))).coalesce(1)
    at = Window.partitionBy("s")
    ahead = at.orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    for r in range(shards):
        state = state.withColumn("s", F.when(F.col("arc") >= 0, F.get("walk", F.lit(r))).otherwise(F.col("s")))
        state = state.select("*", F.max("cap").over(at).alias("room"), F.max("used").over(at).alias("taken"),
                             F.sum("n").over(at).alias("asked"),
                             F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
        got = F.greatest(F.lit(0), F.least(F.col("n"), F.col("room") - F.col("taken") - F.col("before"))).cast("long")
        state = state.withColumn("got", got)
        iv = F.struct((F.col("first") + F.col("placed")).alias("lo"),
                      (F.col("first") + F.col("placed") + F.col("got")).alias("hi"),
                      F.col("s").alias("shard"), (F.col("taken") + F.col("before")).alias("base"))
        state = state.select(
            "arc", "first", "walk", (F.col("n") - F.col("got")).alias("n"), "cap",
            F.when(F.col("arc") < 0, F.least(F.col("cap"), F.col("used") + F.col("asked"))).otherwise(F.lit(0))
            .cast("long").alias("used"), "s", (F.col("placed") + F.col("got")).alias("placed"),
            F.when(F.col("got") > 0, F.concat("ivs", F.array(iv))).otherwise(F.col("ivs")).alias("ivs"))
    return state.where("arc >= 0").select("arc", F.inline("ivs"))


def assign_shards(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0,
                  seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
                  carry: bool = False) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), plus ``_row`` of all columns if ``carry``.

    ``slack`` 0 gives law ``rows``; with slack e a shard holds at most
    ceil((1 + e) * rows / shards) rows and fewer keys leave their home.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text_col), F.lit(""))
    key = h(F.lit("doc"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), seed=seed)
    cols = {"doc_id": F.col(id_col).cast("long"), "size": (F.octet_length(body) + 1).cast("long"),
            "text_crc32": F.crc32(F.encode(body, "UTF-8")), "_key": key, "_rid": F.monotonically_increasing_id()}
    keyed = packed(docs, **cols) if carry else docs.select(*[c.alias(n) for n, c in cols.items()])
    arcs = spark.createDataFrame(ring(shards, vnodes, seed), "arc long, lo int, hi int, walk array<int>")
    slots = arcs.select("arc", F.explode(F.sequence("lo", "hi")).alias("_slot"))   # 2^SLOT_BITS rows
    keyed = keyed.withColumn("_slot", F.shiftright("_key", _SHIFT).cast("int")).join(F.broadcast(slots), "_slot")
    indexed = global_index(keyed, [F.col("arc"), F.col("_key"), F.col("doc_id"), F.col("text_crc32"),
                                   F.col("size"), F.col("_rid")], "_idx")
    counts = indexed.groupBy("arc").agg(F.count(F.lit(1)).alias("n"), F.min("_idx").alias("first"))
    filled = (arcs.groupBy("arc").agg(F.first("walk").alias("walk")).join(F.broadcast(counts), "arc", "left")
              .select("arc", "walk", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                      F.coalesce("first", F.lit(0)).cast("long").alias("first")))
    intervals = stored(_settle(filled, shards, slack), "ring")     # at most shards x vnodes x shards rows
    out = indexed.join(F.broadcast(intervals.withColumnRenamed("arc", "_arc")),
                       (F.col("arc") == F.col("_arc")) & (F.col("_idx") >= F.col("lo")) & (F.col("_idx") < F.col("hi")))
    return out.select(*(["_row"] if carry else []), "doc_id", "size", "text_crc32",
                      F.lit("rows" if slack == 0 else "bounded").alias("law"), "shard",
                      (F.col("base") + F.col("_idx") - F.col("lo")).alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def oracle(shards: int = SHARDS, vnodes: int = VNODES, seed: int = SEED) -> str:
    """The same placement as one DuckDB statement, the rounds written out one by one."""
    def hh(*parts: str) -> str:
        joined = " || '|' || ".join([*parts, f"'{seed}'"])
        return f"('0x' || substr(md5({joined}), 1, 15))::BIGINT"
    n = shards * vnodes
    ctes = [
        f"""points AS (SELECT row_number() OVER (ORDER BY p, s) - 1 AS arc, s, p >> {_SHIFT} AS slot FROM (
            SELECT s, {hh("'ring'", "s::VARCHAR", "v::VARCHAR")} AS p
            FROM range({shards}) a(s), range({vnodes}) b(v)))""",
        f"""near AS (SELECT a.arc, b.s, min((b.arc - a.arc + {n}) % {n}) AS far
            FROM points a, points b GROUP BY a.arc, b.s)""",
        "walks AS (SELECT arc, list(s ORDER BY far) AS walk FROM near GROUP BY arc)",
        f"""keyed AS (SELECT doc_id, text, {hh("'doc'", "coalesce(doc_id::VARCHAR, '')")} AS k FROM documents)""",
        "ends AS (SELECT slot, min(arc) AS arc FROM points GROUP BY slot)",
        f"""homed AS (SELECT k.doc_id, k.text, k.k, coalesce(e.arc, 0) AS arc
            FROM keyed k ASOF LEFT JOIN ends e ON (k.k >> {_SHIFT}) <= e.slot)""",
        """ranked AS (SELECT *, row_number() OVER (PARTITION BY arc ORDER BY k, doc_id) - 1 AS pos FROM homed)""",
        """r0 AS MATERIALIZED (SELECT w.arc, w.walk, coalesce(c.n, 0) AS n, 0::BIGINT AS placed FROM walks w
            LEFT JOIN (SELECT arc, count(*) AS n FROM homed GROUP BY arc) c USING (arc))""",
        f"""u0 AS MATERIALIZED (SELECT s::BIGINT AS s, 0::BIGINT AS used,
            (SELECT sum(n) FROM r0)::BIGINT // {shards}
            + CASE WHEN s < (SELECT sum(n) FROM r0)::BIGINT % {shards} THEN 1 ELSE 0 END AS cap
            FROM range({shards}) t(s))""",
    ]
    for r in range(shards):
        ctes += [
            f"""o{r} AS MATERIALIZED (SELECT x.*, u.s, u.used + b AS base, greatest(0, least(n, u.cap - u.used - b))::BIGINT AS got
                FROM (SELECT *, (coalesce(sum(n) OVER (PARTITION BY walk[{r + 1}] ORDER BY arc
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS b FROM r{r}) x
                JOIN u{r} u ON u.s = x.walk[{r + 1}])""",
            f"r{r + 1} AS MATERIALIZED (SELECT arc, walk, n - got AS n, placed + got AS placed FROM o{r})",
            f"""u{r + 1} AS MATERIALIZED (SELECT u.s, u.cap, u.used + coalesce(g.got, 0)::BIGINT AS used FROM u{r} u
                LEFT JOIN (SELECT s, sum(got) AS got FROM o{r} GROUP BY s) g USING (s))""",
        ]
    ivs = " UNION ALL ".join(f"SELECT arc, s, placed AS lo, placed + got AS hi, base FROM o{r} WHERE got > 0"
                             for r in range(shards))
    poly, ones = 3988292384, 4294967295      # CRC-32, fixed values
    ctes += [
        f"ivs AS ({ivs})",
        f"""tbl AS MATERIALIZED (SELECT list(list_reduce(range(0, 8), lambda c, i: CASE WHEN c % 2 = 1
            THEN xor(c >> 1, {poly}::BIGINT) ELSE c >> 1 END, n) ORDER BY n) AS t FROM range(256) r(n))""",
        """hex AS (SELECT *, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
            lambda v: ('0x' || v)::BIGINT) AS b FROM ranked)""",
    ]
    return f"""WITH {", ".join(ctes)}
    SELECT d.doc_id, (len(d.b) + 1)::BIGINT AS size, xor(list_reduce(d.b, lambda c, v:
           xor(c >> 8, t[(xor(c, v) & 255) + 1]), {ones}::BIGINT), {ones}::BIGINT) AS text_crc32, 'rows' AS law,
           i.s::INTEGER AS shard, (i.base + d.pos - i.lo)::BIGINT AS slot, NULL::INTEGER AS grown_shard
    FROM hex d, tbl, ivs i WHERE d.arc = i.arc AND d.pos >= i.lo AND d.pos < i.hi"""
