"""Secret scans: regex kinds plus character Markov models, in DataFrame functions only.

Base spans come from three patterns, each leftmost and non-overlapping: assign
(keyword, separator, value of 6+ characters), access (``AKIA`` + letters and
digits, 20+ characters), hex (24+ characters).

The method adds spans of kind ``markov``: runs of ``MIN_RUN``+ key-like
characters that overlap no base span and whose log-likelihood ratio between
two first-order character models, random strings against ordinary identifiers,
exceeds ``THRESHOLD`` nats.  Both models are transition tables, counted by
Spark from labelled samples (token, random 0/1); of them only the log ratios,
states x states numbers, pass the driver, to become a constant of the scan.  By default the
samples come from all documents: values found by the base patterns, and the
base64 of their SHA-256 as strings of the wider alphabet, are random; runs of
8+ letters and underscores that no digit adjoins are ordinary.

Positions are code points, ends exclusive, found from the lengths of the
pieces between matches.

Edge cases: null text counts as empty and has no spans; without samples of a
label its model is uniform; a ratio of exactly the threshold is no secret; very
long texts are scanned whole; repeated rows and extra columns make no difference;
an empty table gives no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The patterns and least lengths of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

MIN_RUN = 16
RUN = r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN
ORDINARY = r"(?<![0-9+/=A-Za-z_])[A-Za-z_]{8,}(?![0-9+/=])"
THRESHOLD = 12.0
SMOOTH = 0.5
#: States of the models: these characters and one for all others.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_STATES = len(ALPHABET) + 1
_SPANS = "array<struct<b:int,k:int,e:int>>"


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _spans(text: Column, pattern: str, found: Column, keep: Column, kind: int) -> Column:
    """(begin, kind, end) of the matches ``found`` whose flag in ``keep`` is true."""
    pieces = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p))
    sizes = F.transform(found, lambda m: F.char_length(m))

    def step(acc, x):
        b = acc["at"] + x["p"]
        e = b + x["m"]
        iv = F.struct(b.alias("b"), F.lit(kind).alias("k"), e.alias("e"))
        return F.struct(e.alias("at"), F.when(x["ok"], F.concat(acc["out"], F.array(iv))).otherwise(acc["out"]).alias("out"))
    zipped = F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("p"), sizes.alias("m"), keep.alias("ok"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    return F.when(F.exists(keep, lambda k: k), F.aggregate(zipped, start, step)["out"]) \
        .otherwise(F.array().cast(_SPANS))


def _base(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with _assign, _access, _hex spans."""
    # greedy runs from the leftmost start: a least length inside the pattern gives the same hex and access spans
    access = r"AKIA[A-Z0-9]{%d,}" % (LEAST["access"] - 4)
    hexes = r"[0-9a-f]{%d,}" % LEAST["hex"]
    t = F.col(text)
    df = docs.withColumns({"_ma": _matches(t, ASSIGN), "_mk": _matches(t, access), "_mh": _matches(t, hexes)})
    df = df.withColumn("_mv", F.when(F.size("_ma") > 0, _matches(t, ASSIGN, 2)).otherwise(F.array().cast("array<string>")))
    long_enough = F.transform("_mv", lambda v: F.char_length(v) >= LEAST["assign"])
    every = lambda c: F.transform(c, lambda _: F.lit(True))
    return df.withColumns({"_assign": _spans(t, ASSIGN, F.col("_ma"), long_enough, 0),
                           "_access": _spans(t, access, F.col("_mk"), every("_mk"), 1),
                           "_hex": _spans(t, hexes, F.col("_mh"), every("_mh"), 2)})


def samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Labelled tokens (token, random) found in all documents, each distinct token once."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    values = F.filter(_matches(t, ASSIGN, 2), lambda v: F.char_length(v) >= LEAST["assign"])
    keys = F.concat(values, _matches(t, r"AKIA[A-Z0-9]{%d,}" % (LEAST["access"] - 4)),
                    _matches(t, r"[0-9a-f]{%d,}" % LEAST["hex"]))
    rand = F.transform(F.array_distinct(keys), lambda v: F.struct(v.alias("token"), F.lit(1).alias("random")))
    wide = F.transform(F.array_distinct(keys), lambda v: F.struct(
        F.base64(F.unhex(F.sha2(v, 256))).alias("token"), F.lit(1).alias("random")))
    words = F.transform(F.array_distinct(_matches(t, ORDINARY)),
                        lambda v: F.struct(v.alias("token"), F.lit(0).alias("random")))
    return docs.select(F.explode(F.concat(rand, wide, words)).alias("s")).select("s.*").distinct()


def _transitions(token: Column) -> Column:
    """Codes previous * states + next of a token's neighbouring characters (0: outside the alphabet)."""
    place = F.array(*[F.lit(ALPHABET.find(chr(i)) + 1) for i in range(128)])
    c = F.transform(F.split(token, ""), lambda x: F.coalesce(F.get(place, F.ascii(x)), F.lit(0)))
    n = F.greatest(F.size(c) - 1, F.lit(0))
    return F.zip_with(F.slice(c, F.lit(1), n), F.slice(c, F.lit(2), n), lambda a, b: a * _STATES + b)


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratios of all transitions, from (token, random 0/1)."""
    spark = labelled.sparkSession
    seen = (labelled.where(F.col("random").isNotNull() & F.col("token").isNotNull())
            .select("random", F.explode(_transitions(F.col("token"))).alias("t"))
            .groupBy("t").agg(*[F.count(F.when(F.col("random") == y, 1)).alias(f"n{y}") for y in (0, 1)]))
    cells = spark.range(_STATES * _STATES).select(F.col("id").cast("int").alias("t")).join(F.broadcast(seen), "t", "left")
    row = Window.partitionBy(F.floor(F.col("t") / _STATES))

    def logp(y: int) -> Column:
        n = F.coalesce(F.col(f"n{y}"), F.lit(0))
        return F.ln((n + SMOOTH) / (F.sum(n).over(row) + SMOOTH * _STATES))
    ratios = cells.select("t", F.round(logp(1) - logp(0), 4).alias("r")).orderBy("t").collect()    # states x states rows
    return [x.r for x in ratios]


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov) of every document."""
    model = train(samples(docs, text_col) if labelled is None else labelled)
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")      # a constant: folded once
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    df = _base(df, "_t").withColumn("_mr", _matches(F.col("_t"), RUN))

    def ratio(token):
        return F.aggregate(_transitions(token), F.lit(0.0), lambda s, i: s + F.get(table, i))
    df = df.withColumn("_flag", F.transform("_mr", lambda m: ratio(m) > threshold))
    df = df.withColumn("_run", _spans(F.col("_t"), RUN, F.col("_mr"), F.col("_flag"), 3))
    df = df.withColumn("_all", F.concat("_assign", "_access", "_hex"))
    df = df.withColumn("_markov", F.filter("_run", lambda r: ~F.exists(
        "_all", lambda b: (b["b"] < r["e"]) & (r["b"] < b["e"]))))
    kinds = F.array(*[F.lit(k) for k in ("assign", "access", "hex", "markov")])

    def joined(spans):
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
            ":", F.get(kinds, s["k"]), s["b"].cast("string"), s["e"].cast("string"))), ",")
    return df.select(
        "doc_id", F.size("_assign").cast("long").alias("n_assign"), F.size("_access").cast("long").alias("n_access"),
        F.size("_hex").cast("long").alias("n_hex"), F.sha2(joined(F.col("_all")), 256).alias("base_sha256"),
        joined(F.concat("_all", "_markov")).alias("spans"), F.size("_markov").cast("long").alias("n_markov"))
