"""SQL (DuckDB dialect) mirrors of ``tidemark.sources.adapters`` for the oracle.

Each function returns a SELECT over the driver's pre-registered views.  They
are independent re-statements of the derivations, not generated from the
Spark code.
"""

from __future__ import annotations

from tidemark.schemas import INTERVAL_MS


def interval_case(col: str = "interval") -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in INTERVAL_MS.items())
    return f"(CASE {col} {whens} END)"


def bars_events(every: str = "1h") -> str:
    ms = INTERVAL_MS[every]
    return f"""
SELECT 'EVT' AS exchange, event_type AS symbol, '{every}' AS interval,
       (epoch_us(ts) // 1000) - ((epoch_us(ts) // 1000) % {ms}) AS open_time,
       (epoch_us(ts) // 1000) - ((epoch_us(ts) // 1000) % {ms}) + {ms - 1} AS close_time,
       first(value ORDER BY (epoch_us(ts) // 1000), event_id) AS open,
       max(value) AS high, min(value) AS low,
       last(value ORDER BY (epoch_us(ts) // 1000), event_id) AS close,
       CAST(count(*) AS DOUBLE) AS volume
FROM events GROUP BY 1, 2, 3, 4, 5"""


def bars_lineitem() -> str:
    o = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
    return f"""
SELECT 'TPCH' AS exchange, l_returnflag AS symbol, '1d' AS interval,
       (epoch_us(l_shipdate) // 1000) AS open_time, (epoch_us(l_shipdate) // 1000) + {INTERVAL_MS['1d'] - 1} AS close_time,
       first(l_extendedprice ORDER BY {o}) AS open, max(l_extendedprice) AS high,
       min(l_extendedprice) AS low, last(l_extendedprice ORDER BY {o}) AS close,
       sum(l_quantity) AS volume
FROM lineitem GROUP BY 1, 2, 3, 4, 5"""


def bars_all() -> str:
    return f"({bars_events('1h')}) UNION ALL ({bars_lineitem()})"


def alerts() -> str:
    return """
SELECT event_id AS id, (epoch_us(ts) // 1000) AS ts, (epoch_us(ts) // 1000) AS created_ts, 'EVT' AS exchange,
       event_type AS symbol,
       CASE WHEN user_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS signal,
       CASE WHEN user_id % 4 < 2 THEN '15m' ELSE '1h' END AS source_tf,
       value AS price, event_type AS reason, (user_id % 10) / 10.0::DOUBLE AS setup_score,
       CASE WHEN user_id % 10 >= 7 THEN 'A' WHEN user_id % 10 >= 4 THEN 'B' ELSE 'C' END AS setup_grade,
       CAST(NULL AS VARCHAR) AS avoid_reasons, props AS metrics_json
FROM events"""


def trade_plans() -> str:
    return f"""
SELECT id, id AS alert_id, ts, exchange, symbol, signal AS side,
       CASE WHEN id % 3 = 0 THEN 'limit' ELSE 'market' END AS entry_type,
       price AS entry_price, stop AS stop_loss,
       price + sgn * 1.5::DOUBLE * risk AS tp1, price + sgn * 3.0::DOUBLE * risk AS tp2,
       CASE WHEN id % 7 = 0 THEN NULL ELSE price + sgn * 4.5::DOUBLE * risk END AS tp3,
       risk / 1.5::DOUBLE AS atr, CASE WHEN id % 101 = 0 THEN 60.0::DOUBLE ELSE 1.5::DOUBLE END AS atr_mult,
       CASE id % 3 WHEN 0 THEN 'swing_low' WHEN 1 THEN 'swing_high' ELSE 'none' END AS swing_ref,
       CASE WHEN id % 61 = 0 THEN abs(price - stop) * 3.0::DOUBLE ELSE abs(price - stop) END AS risk_per_unit,
       1.5::DOUBLE AS rr_tp1, 3.0::DOUBLE AS rr_tp2, CASE WHEN id % 59 = 0 THEN 75.0::DOUBLE ELSE 4.5::DOUBLE END AS rr_tp3,
       metrics_json AS plan_json
FROM (
  SELECT *, CASE WHEN id % 53 = 0 THEN NULL ELSE price - sgn * flip * risk END AS stop
  FROM (SELECT *, price * 0.02::DOUBLE + 0.01::DOUBLE AS risk,
               CASE WHEN signal = 'BUY' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sgn,
               CASE WHEN id % 47 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS flip
        FROM ({alerts()}) a) b) c"""


def snapshot_rows() -> str:
    """The flat rows the snapshot JSON documents are built from (broken docs
    are those with snapshot_id % 5 = 4)."""
    return """
SELECT CAST(floor(c_custkey / 50) AS BIGINT) AS snapshot_id,
       CASE WHEN CAST(floor(c_custkey / 50) AS BIGINT) % 2 = 0 THEN 'binance' ELSE 'bybit' END AS snap_exchange,
       1704067200000 + CAST(floor(c_custkey / 50) AS BIGINT) * 3600000 AS snap_ts,
       c_name AS symbol, c_mktsegment AS exchange, c_acctbal AS last_price,
       CASE WHEN c_acctbal > 0 THEN c_acctbal * 1000000.0::DOUBLE END AS market_cap,
       c_custkey % 300 + 1 AS liquidity_rank, c_custkey % 300 < 200 AS liquidity_top200,
       CASE c_nationkey % 3 WHEN 0 THEN 'strong' WHEN 1 THEN 'moderate' ELSE 'weak' END AS signal_strength,
       CASE WHEN c_acctbal >= 0 THEN 'bullish' ELSE 'bearish' END AS mtf_summary,
       [lower(c_mktsegment), 'n' || CAST(c_nationkey AS VARCHAR)] AS sector_tags,
       (c_custkey % 200 - 100) / 10.0::DOUBLE AS change_60m, (c_custkey % 40 - 20) / 10.0::DOUBLE AS change_15m,
       abs(c_acctbal) AS vol_1m, CAST(c_custkey % 100 AS DOUBLE) AS rsi_14,
       CAST(c_custkey % 21 - 10 AS DOUBLE) AS momentum_score, CAST(c_custkey * 10 AS DOUBLE) AS open_interest,
       c_acctbal / 1000000.0::DOUBLE AS funding_rate
FROM customer"""


def market_caps() -> str:
    return """
SELECT c_name AS symbol, 1704067200000 + c_custkey AS ts, c_acctbal * 1000000.0::DOUBLE AS market_cap
FROM customer WHERE c_acctbal > 0"""


def rnd(x: str, n: int = 6) -> str:
    """Round like Spark's ``round(double, n)``: HALF_UP on the shortest decimal
    form of the double (DuckDB's own double rounding multiplies in binary)."""
    return f"CAST(round(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 20)), {n}) AS DOUBLE)"
