"""Shared CTEs for the oracle SQL (DuckDB dialect) over the driver's tables."""

from __future__ import annotations

from ..operators.splits import FIXTURE_PERIODS, PHASES

EV = """ev AS (
  SELECT o_custkey AS visitorid, l_partkey AS itemid,
         CASE l_returnflag WHEN 'N' THEN 'view' WHEN 'A' THEN 'addtocart' ELSE 'transaction' END AS event,
         epoch_us(o_orderdate) // 1000 AS timestamp,
         CASE WHEN l_returnflag = 'R' THEN l_orderkey END AS transactionid,
         CAST(o_orderdate AS DATE) AS date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

CLICKS_RAW = """clk_raw AS (
  SELECT user_id AS visitorid,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS itemid,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'addtocart'
                         WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
         epoch_us(ts) // 1000 AS timestamp,
         CASE WHEN event_type = 'purchase' THEN event_id END AS transactionid
  FROM events)"""

CLICKS = """clk AS (
  SELECT *, CAST(to_timestamp(timestamp / 1000.0) AT TIME ZONE 'UTC' AS DATE) AS date_utc
  FROM clk_raw WHERE event IN ('view', 'addtocart', 'transaction'))"""


def _period(name: str) -> str:
    lo, hi = FIXTURE_PERIODS[name]
    return f"{name} AS (SELECT * FROM ev WHERE date BETWEEN DATE '{lo}' AND DATE '{hi}')"


def _dict(name: str, col: str, src: str) -> str:
    return (f"{name} AS (SELECT raw, row_number() OVER (ORDER BY raw) - 1 AS idx "
            f"FROM (SELECT DISTINCT {col} AS raw FROM {src}))")


def phase_ctes(phase: str) -> list[str]:
    tr, ev = PHASES[phase]
    return [
        f"tr AS (SELECT * FROM {tr})",
        f"fu AS (SELECT * FROM {ev})",
        "wa AS (SELECT * FROM fu WHERE visitorid IN (SELECT visitorid FROM tr) "
        "AND itemid IN (SELECT itemid FROM tr))",
        "co AS (SELECT * FROM fu WHERE visitorid NOT IN (SELECT visitorid FROM tr))",
        _dict("du_w", "visitorid", "tr"),
        _dict("di_w", "itemid", "tr"),
        _dict("du_f", "visitorid", "(SELECT visitorid FROM tr UNION ALL SELECT visitorid FROM fu)"),
        _dict("di_f", "itemid", "(SELECT itemid FROM tr UNION ALL SELECT itemid FROM fu)"),
        _dict("de", "event", "tr"),
    ]


def cells_sql(split: str, scope: str) -> str:
    s = "w" if scope == "warm" else "f"
    return (f"SELECT u.idx AS user_idx, i.idx AS item_idx, CAST(sum(e.idx) AS DOUBLE) AS weight "
            f"FROM {split} x JOIN du_{s} u ON x.visitorid = u.raw JOIN di_{s} i ON x.itemid = i.raw "
            f"JOIN de e ON x.event = e.raw GROUP BY 1, 2")


def with_sql(body: str, phase: str | None = None, extra: list[str] | None = None) -> str:
    ctes = [EV] + [_period(p) for p in FIXTURE_PERIODS]
    if phase:
        ctes += phase_ctes(phase)
    ctes += extra or []
    return "WITH " + ",\n".join(ctes) + "\n" + body


def both_phases(body_fn, extra_fn=None) -> str:
    """UNION ALL of one SELECT per phase, each wrapped with that phase's CTEs."""
    parts = []
    for ph in PHASES:
        extra = extra_fn(ph) if extra_fn else None
        parts.append("SELECT * FROM (" + with_sql(body_fn(ph), ph, extra) + ")")
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------ frozen factors
def h_sql(*parts: str, seed: int = 42) -> str:
    joined = ", ".join(list(parts) + [f"'{seed}'"])
    return f"('0x' || substr(md5(concat_ws('|', {joined})), 1, 15))::BIGINT"


def frozen_sql(name: str, tag: str, side: str, ids_sql: str) -> str:
    """CTE ``name``(id, bias, f0..f3) with the same integer factors as the Spark fixture."""
    ident = "CAST(id AS VARCHAR)"
    dims = ", ".join(
        f"CAST(({h_sql(repr(tag), repr(side), ident, repr(str(d)))} % 21) - 10 AS DOUBLE) AS f{d}" for d in range(4))
    bias = f"CAST(({h_sql(repr(tag), repr(side), ident, repr('b'))} % 11) - 5 AS DOUBLE) AS bias"
    return f"{name} AS (SELECT id, {bias}, {dims} FROM ({ids_sql}) t(id))"


def score_sql(kind: str, u: str = "u", i: str = "i") -> str:
    dot = " + ".join(f"{u}.f{d} * {i}.f{d}" for d in range(4))
    if kind == "dot":
        return f"({dot})"
    raw = f"({u}.bias + {i}.bias + ({dot}))"
    if kind == "biased":
        return raw
    return f"least(5.0, greatest(1.0, 3.0 + CAST({raw} AS DOUBLE) / CAST(100 AS DOUBLE)))"
