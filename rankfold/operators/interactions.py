"""Long-form interaction cells (no matrix object).

A cell is (user_idx, item_idx, weight) with weight = sum of the event weights
of the rows that fall on it.  By default the weight of an event is its code in
the event dictionary fit on the training rows (alphabetical: addtocart 0,
transaction 1, view 2), which is what the reference stores; pass ``weights``
to use a signal map instead.  A cell whose sum is 0 is stored but does not
count as "non-zero" (seen / ground truth).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dictionary import fit_dictionaries, phase_dictionaries
from .splits import FIXTURE_PERIODS, PHASES, PhaseSplits, period_range

# fixed values: a sensible signal map offered as an alternative
SIGNAL_WEIGHTS = {"view": 1.0, "addtocart": 2.0, "transaction": 3.0}


def event_weights(event_dict: DataFrame, weights: dict | None = None) -> DataFrame:
    """(event, weight); at most one row per event label, so broadcast-safe."""
    if weights is None:
        return event_dict.select(F.col("raw").alias("event"), F.col("idx").cast("double").alias("weight"))
    spark = event_dict.sparkSession
    return spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "event string, weight double")


def cells(events: DataFrame, dicts: dict[str, DataFrame], weights: dict | None = None) -> DataFrame:
    """Sum of event weights per (user_idx, item_idx)."""
    ew = F.broadcast(event_weights(dicts["event"], weights))
    users = dicts["visitorid"].select(F.col("raw").alias("visitorid"), F.col("idx").alias("user_idx"))
    items = dicts["itemid"].select(F.col("raw").alias("itemid"), F.col("idx").alias("item_idx"))
    # raw rows are summed per pair first, map side included: only pairs meet the dictionaries
    pairs = (events.select("visitorid", "itemid", "event").join(ew, "event")
             .groupBy("visitorid", "itemid").agg(F.sum("weight").cast("double").alias("weight")))
    return pairs.join(users, "visitorid").join(items, "itemid").select("user_idx", "item_idx", "weight")


def nonzero(c: DataFrame) -> DataFrame:
    """Cells that count as interactions (weight != 0 after the per-cell sum)."""
    return c.filter(F.col("weight") != 0)


# (phase, scope) -> {matrix name: split attribute}
MATRIX_LAYOUT = {
    ("tune", "warm"): {"train_val": "train", "validation_warm": "eval_warm"},
    ("tune", "full"): {"train_val": "train", "validation_full": "eval_full", "validation_cold": "eval_cold"},
    ("final", "warm"): {"train": "train", "test_warm": "eval_warm"},
    ("final", "full"): {"train": "train", "test_full": "eval_full", "test_cold": "eval_cold"},
}


def phase_bundle(sp: PhaseSplits, scope: str, weights: dict | None = None,
                 dicts: dict | None = None) -> tuple[dict, dict]:
    """All matrices of one (phase, scope) bundle plus its dictionaries."""
    dicts = dicts or phase_dictionaries(sp, scope)
    mats = {name: cells(getattr(sp, attr), dicts, weights)
            for name, attr in MATRIX_LAYOUT[(sp.phase, scope)].items()}
    return mats, dicts


def period_sums(events: DataFrame, periods: dict | None = None) -> DataFrame:
    """(visitorid, itemid, period, event, n): the log read once, pre-aggregated, written to the shared folder."""
    periods = periods or FIXTURE_PERIODS
    tag = F.lit(None).cast("string")
    for name, bounds in periods.items():
        lo, hi = period_range(*bounds)
        tag = F.when((F.col("timestamp") >= lo) & (F.col("timestamp") < hi), F.lit(name)).otherwise(tag)
    spans = [period_range(*b) for b in periods.values()]
    rows = events.filter((F.col("timestamp") >= min(lo for lo, _ in spans)) & (F.col("timestamp") < max(hi for _, hi in spans)))
    return (rows.select("visitorid", "itemid", "event", tag.alias("period")).filter(F.col("period").isNotNull())
            .groupBy("visitorid", "itemid", "period", "event").agg(F.count(F.lit(1)).alias("n")).checkpoint())


#: (phase, role) of every period's rows.
_ROLES = [(name, phase, role) for phase, pair in PHASES.items() for name, role in zip(pair, ("train", "eval"))]


def _index_columns(sums: DataFrame, col: str) -> DataFrame:
    """(phase, raw, warm, full): the place of every id in its phase's warm and full dictionary, null where it is in none."""
    specs = {}
    for phase, (train, ev) in PHASES.items():
        specs[f"{phase}/warm"] = ([sums.filter(F.col("period") == train)], col)
        specs[f"{phase}/full"] = ([sums.filter(F.col("period").isin(train, ev))], col)
    out = None
    for name, d in fit_dictionaries(specs).items():
        phase, scope = name.split("/")
        part = d.select(F.lit(phase).alias("phase"), F.lit(scope).alias("scope"), "raw", "idx")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("phase", "raw").agg(*[F.max(F.when(F.col("scope") == x, F.col("idx"))).alias(x)
                                             for x in ("warm", "full")])


def all_interactions(sums: DataFrame, weights: dict | None = None) -> DataFrame:
    """I4: the ten matrices as one long table (phase, scope, matrix, user_idx, item_idx, weight).

    ``sums``: the ``period_sums`` of the log, which is read and shuffled once for them.  A pair's training and
    evaluation weights of both phases are one row each; which matrices the pair
    belongs to follows from its ids' places in the dictionaries (no place in the
    warm dictionary: not seen in training), so one explode makes the cells.
    """
    roles = F.array(*[F.struct(F.lit(p).alias("period"), F.lit(ph).alias("phase"), F.lit(r).alias("role"))
                      for p, ph, r in _ROLES])
    rows = (sums.withColumn("_r", F.explode(F.filter(roles, lambda x: x["period"] == F.col("period"))))
            .select("visitorid", "itemid", "event", "n", F.col("_r.phase").alias("phase"), F.col("_r.role").alias("role")))
    if weights is None:
        # the labels of each training period in alphabetical order; a closed vocabulary
        labels = rows.filter(F.col("role") == "train").select("phase", "event").distinct()
        codes = labels.select("phase", "event", (F.dense_rank().over(Window.partitionBy("phase").orderBy("event")) - 1)
                              .cast("double").alias("_w"))
    else:
        codes = sums.sparkSession.createDataFrame([(ph, k, float(v)) for ph in PHASES for k, v in weights.items()],
                                                    "phase string, event string, _w double")
    part = lambda role, x: F.when(F.col("role") == role, x)
    pairs = rows.join(F.broadcast(codes), ["phase", "event"]).groupBy("phase", "visitorid", "itemid").agg(
        *[F.sum(part(r, F.col("n") * F.col("_w"))).cast("double").alias(r) for r in ("train", "eval")])
    side = {}
    for col, name in (("visitorid", "u"), ("itemid", "i")):
        side[col] = _index_columns(sums, col).select("phase", F.col("raw").alias(col), F.col("warm").alias(f"{name}w"),
                                                     F.col("full").alias(f"{name}f"))
    pairs = pairs.join(side["visitorid"], ["phase", "visitorid"]).join(side["itemid"], ["phase", "itemid"])

    def cell(phase, scope, name, role, when):
        u, i = ("uw", "iw") if scope == "warm" else ("uf", "if")
        return F.when((F.col("phase") == phase) & F.col(role).isNotNull() & when, F.struct(
            F.lit(scope).alias("scope"), F.lit(name).alias("matrix"), F.col(u).alias("user_idx"),
            F.col(i).alias("item_idx"), F.col(role).alias("weight")))
    known = F.col("uw").isNotNull() & F.col("iw").isNotNull()
    rule = {"train": F.lit(True), "eval_warm": known, "eval_full": F.lit(True), "eval_cold": F.col("uw").isNull()}
    made = [cell(phase, scope, name, attr.split("_")[0], rule[attr])
            for (phase, scope), mats in MATRIX_LAYOUT.items() for name, attr in mats.items()]
    return (pairs.select("phase", F.explode(F.array_compact(F.array(*made))).alias("_c"))
            .select("phase", "_c.scope", "_c.matrix", "_c.user_idx", "_c.item_idx", "_c.weight"))


def all_matrix_stats(cells_long: DataFrame, sizes: DataFrame) -> DataFrame:
    """A10 of every matrix of ``all_interactions`` in one pass; ``sizes``: (phase, scope, n_users, n_items)."""
    nz = F.col("weight") != 0
    return (cells_long.groupBy("phase", "scope", "matrix").agg(
        F.count(F.lit(1)).alias("stored_cells"), F.count(F.when(nz, 1)).alias("nonzero_cells"),
        F.countDistinct(F.when(nz, F.col("user_idx"))).alias("users_with_interactions"))
        .join(F.broadcast(sizes), ["phase", "scope"])                       # four rows
        .select("phase", "scope", "matrix", "n_users", "n_items", "stored_cells", "nonzero_cells", "users_with_interactions"))


def dictionary_sizes(sums: DataFrame) -> DataFrame:
    """(phase, scope, n_users, n_items) of every dictionary, from ``period_sums``."""
    roles = F.array(*[F.struct(F.lit(p).alias("period"), F.lit(ph).alias("phase"), F.lit(sc).alias("scope"))
                      for p, ph, r in _ROLES for sc in (("warm", "full") if r == "train" else ("full",))])
    return (sums.withColumn("_r", F.explode(F.filter(roles, lambda x: x["period"] == F.col("period"))))
            .groupBy("_r.phase", "_r.scope").agg(F.countDistinct("visitorid").alias("n_users"),
                                                 F.countDistinct("itemid").alias("n_items")))


def one_row(aggs: list[DataFrame]) -> DataFrame:
    """Combine several one-row aggregates (disjoint column names) into one row without a join."""
    long = None
    for df in aggs:
        long = df if long is None else long.unionByName(df, allowMissingColumns=True)
    cols = [c for df in aggs for c in df.columns]
    return long.agg(*[F.max(c).alias(c) for c in cols])


def matrix_stats(c: DataFrame, dicts: dict[str, DataFrame]) -> DataFrame:
    """A10: shape (dictionary sizes) and stored / non-zero cell counts, one row, one pass per input."""
    nz = F.col("weight") != 0
    row = one_row([
        dicts["visitorid"].agg(F.count(F.lit(1)).alias("n_users")),
        dicts["itemid"].agg(F.count(F.lit(1)).alias("n_items")),
        c.agg(F.count(F.lit(1)).alias("stored_cells"),
              F.count(F.when(nz, 1)).alias("nonzero_cells"),
              F.countDistinct(F.when(nz, F.col("user_idx"))).alias("users_with_interactions")),
    ])
    return row.select(*[F.col(n).cast("long").alias(n) for n in row.columns])


def raw_cells(events: DataFrame, weights: dict | None = None) -> DataFrame:
    """A9 keyed by raw IDs: (visitorid, itemid, weight), event codes fit on ``events``.

    The dictionaries are bijections, so these are the same cells as ``cells``
    without the two encode joins; serving and evaluation use them directly.
    """
    if weights is None:
        codes = (events.select("event").distinct()
                 .select(F.col("event"),
                         # over the distinct labels only (a closed vocabulary of three)
                         (F.dense_rank().over(Window.orderBy("event")) - 1).cast("double").alias("weight")))
    else:
        codes = events.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()],
                                                    "event string, weight double")
    return (events.select("visitorid", "itemid", "event")
            .join(F.broadcast(codes), "event")
            .groupBy("visitorid", "itemid").agg(F.sum("weight").cast("double").alias("weight")))
