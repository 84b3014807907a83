"""Registered queries: data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import sqlsrc
from tidemark.catalog.common import bars_all, prep
from tidemark.operators import quality as Q
from tidemark.sources import adapters as A

QUERIES, SQL = {}, {}

BARS_CTE = f"WITH bars AS ({sqlsrc.bars_all()})"


def d1_bar_quality(spark, sf):
    return Q.bar_quality(bars_all(spark, sf))


SQL["d1_bar_quality"] = BARS_CTE + f""",
f AS (
  SELECT *, {sqlsrc.interval_case()} AS expected_ms,
         open_time - lag(open_time) OVER (PARTITION BY exchange, symbol, interval
                                          ORDER BY open_time, open, high, low, close, volume) AS dt
  FROM bars)
SELECT exchange, symbol, interval, expected_ms, count(*) AS bars,
       count(*) FILTER (WHERE dt IS NOT NULL AND dt <> expected_ms) AS gap_bars,
       count(*) FILTER (WHERE dt IS NOT NULL AND dt = 0) AS dup_bars,
       count(*) FILTER (WHERE low > high OR high < greatest(open, close) OR low > least(open, close)) AS invalid_bars,
       min(open_time) AS min_open_time, max(open_time) AS max_open_time,
       count(*) FILTER (WHERE dt IS NOT NULL AND dt <> expected_ms) / count(*) AS gap_frac,
       count(*) FILTER (WHERE dt IS NOT NULL AND dt = 0) / count(*) AS dup_frac,
       count(*) FILTER (WHERE low > high OR high < greatest(open, close) OR low > least(open, close)) / count(*) AS invalid_frac
FROM f GROUP BY 1, 2, 3, 4"""

D2_ARGS = dict(min_bars=500, max_gap_frac=0.1, max_dup_frac=0.0001, max_invalid_frac=0.0001)


def d2_clean_universe(spark, sf):
    return Q.clean_universe(Q.bar_quality(bars_all(spark, sf)), **D2_ARGS)


SQL["d2_clean_universe"] = f"""
WITH q AS ({SQL['d1_bar_quality']})
SELECT exchange, symbol, interval, expected_ms, bars, gap_bars, dup_bars, invalid_bars, gap_frac, dup_frac,
       invalid_frac, min_open_time, max_open_time,
       make_timestamp(min_open_time * 1000) AS min_open_dt_utc, make_timestamp(max_open_time * 1000) AS max_open_dt_utc,
       timezone('Australia/Sydney', make_timestamp(min_open_time * 1000) AT TIME ZONE 'UTC') AS min_open_dt_syd,
       timezone('Australia/Sydney', make_timestamp(max_open_time * 1000) AT TIME ZONE 'UTC') AS max_open_dt_syd
FROM q WHERE bars >= {D2_ARGS['min_bars']} AND gap_frac <= {D2_ARGS['max_gap_frac']}
  AND dup_frac <= {D2_ARGS['max_dup_frac']} AND invalid_frac <= {D2_ARGS['max_invalid_frac']}"""


def d3_column_coverage(spark, sf):
    prep(spark)
    return Q.column_coverage(A.trade_plans(spark, sf))


_PLAN_COLS = ["id", "alert_id", "ts", "exchange", "symbol", "side", "entry_type", "entry_price", "stop_loss", "tp1",
              "tp2", "tp3", "atr", "atr_mult", "swing_ref", "risk_per_unit", "rr_tp1", "rr_tp2", "rr_tp3", "plan_json"]
SQL["d3_column_coverage"] = f"WITH p AS ({sqlsrc.trade_plans()}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS non_null, count(*) - count({c}) AS \"null\", "
    f"round(count({c}) * 100.0 / count(*), 6) AS pct_non_null FROM p" for c in _PLAN_COLS)


def d4_plan_sides(spark, sf):
    prep(spark)
    return Q.plan_side_summary(A.trade_plans(spark, sf))


SQL["d4_plan_sides"] = f"""
WITH p AS ({sqlsrc.trade_plans()}),
c AS (
  SELECT upper(side) AS side,
    CASE WHEN upper(side) = 'BUY' THEN stop_loss < entry_price WHEN upper(side) = 'SELL' THEN stop_loss > entry_price END AS stop_ok,
    CASE WHEN tp1 IS NULL THEN TRUE WHEN upper(side) = 'BUY' THEN tp1 > entry_price WHEN upper(side) = 'SELL' THEN tp1 < entry_price END AS tp1_ok,
    CASE WHEN tp2 IS NULL THEN TRUE WHEN upper(side) = 'BUY' THEN tp2 > entry_price WHEN upper(side) = 'SELL' THEN tp2 < entry_price END AS tp2_ok,
    CASE WHEN tp3 IS NULL THEN TRUE WHEN upper(side) = 'BUY' THEN tp3 > entry_price WHEN upper(side) = 'SELL' THEN tp3 < entry_price END AS tp3_ok
  FROM p)
SELECT side, count(*) AS n, count(*) FILTER (WHERE NOT stop_ok) AS stop_wrong,
       count(*) FILTER (WHERE stop_ok IS NULL) AS stop_unknown,
       count(*) FILTER (WHERE NOT tp1_ok) AS tp1_wrong, count(*) FILTER (WHERE NOT tp2_ok) AS tp2_wrong,
       count(*) FILTER (WHERE NOT tp3_ok) AS tp3_wrong
FROM c GROUP BY side"""


def d5_plan_risk(spark, sf):
    prep(spark)
    return Q.plan_risk_checks(A.trade_plans(spark, sf))


SQL["d5_plan_risk"] = f"""
WITH p AS ({sqlsrc.trade_plans()}),
r AS (SELECT *, abs(entry_price - stop_loss) AS dist,
             CASE WHEN abs(entry_price - stop_loss) <> 0 THEN risk_per_unit / abs(entry_price - stop_loss) END AS ratio FROM p)
SELECT count(*) AS n, count(*) FILTER (WHERE entry_price IS NULL) AS missing_entry,
       count(*) FILTER (WHERE stop_loss IS NULL) AS missing_stop,
       count(*) FILTER (WHERE dist <= 1e-9) AS zero_risk,
       count(*) FILTER (WHERE ratio < 0.5 OR ratio > 2.0) AS risk_ratio_out,
       count(*) FILTER (WHERE atr_mult > 50.0) AS atr_mult_outliers,
       count(*) FILTER (WHERE rr_tp1 > 50.0 OR rr_tp2 > 50.0 OR rr_tp3 > 50.0) AS rr_outliers
FROM r"""


def d7_offending_plans(spark, sf):
    prep(spark)
    return Q.offending_plans(A.trade_plans(spark, sf), n=20)


SQL["d7_offending_plans"] = f"""
WITH p AS ({sqlsrc.trade_plans()}),
c AS (
  SELECT *,
    CASE WHEN upper(side) = 'BUY' THEN stop_loss < entry_price WHEN upper(side) = 'SELL' THEN stop_loss > entry_price END AS stop_ok,
    CASE WHEN tp1 IS NULL THEN TRUE WHEN upper(side) = 'BUY' THEN tp1 > entry_price WHEN upper(side) = 'SELL' THEN tp1 < entry_price END AS tp1_ok,
    CASE WHEN tp2 IS NULL THEN TRUE WHEN upper(side) = 'BUY' THEN tp2 > entry_price WHEN upper(side) = 'SELL' THEN tp2 < entry_price END AS tp2_ok,
    CASE WHEN tp3 IS NULL THEN TRUE WHEN upper(side) = 'BUY' THEN tp3 > entry_price WHEN upper(side) = 'SELL' THEN tp3 < entry_price END AS tp3_ok,
    CASE WHEN abs(entry_price - stop_loss) <> 0 THEN risk_per_unit / abs(entry_price - stop_loss) END AS ratio
  FROM p)
SELECT id, symbol, side, entry_price, stop_loss, tp1, risk_per_unit, stop_ok, tp1_ok FROM c
WHERE NOT coalesce(stop_ok, TRUE) OR NOT tp1_ok OR NOT tp2_ok OR NOT tp3_ok OR ratio < 0.5 OR ratio > 2.0
ORDER BY id LIMIT 20"""

for _n, _f in list(globals().items()):
    if callable(_f) and _n[:1] == "d" and _n[1:2].isdigit():
        QUERIES[_n] = _f
