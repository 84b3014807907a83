"""Table schemas and fixed lookup values."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ("exchange", "symbol", "interval")

# Bar interval label -> milliseconds (must match the source data).
INTERVAL_MS = {
    "1m": 60_000,
    "3m": 180_000,
    "5m": 300_000,
    "15m": 900_000,
    "30m": 1_800_000,
    "1h": 3_600_000,
    "2h": 7_200_000,
    "4h": 14_400_000,
    "6h": 21_600_000,
    "8h": 28_800_000,
    "12h": 43_200_000,
    "1d": 86_400_000,
}

LOCAL_TZ = "Australia/Sydney"


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, L, D, TS, B, I = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType(), T.BooleanType(), T.IntegerType()

OHLC = _s(("id", L), ("exchange", S), ("symbol", S), ("interval", S), ("open_time", L), ("close_time", L),
          ("open", D), ("high", D), ("low", D), ("close", D), ("volume", D))

ALERTS = _s(("id", L), ("ts", L), ("created_ts", L), ("exchange", S), ("symbol", S), ("signal", S),
            ("source_tf", S), ("price", D), ("reason", S), ("setup_score", D), ("setup_grade", S),
            ("avoid_reasons", S), ("metrics_json", S))

TRADE_PLANS = _s(("id", L), ("alert_id", L), ("ts", L), ("exchange", S), ("symbol", S), ("side", S),
                 ("entry_type", S), ("entry_price", D), ("stop_loss", D), ("tp1", D), ("tp2", D), ("tp3", D),
                 ("atr", D), ("atr_mult", D), ("swing_ref", S), ("risk_per_unit", D), ("rr_tp1", D),
                 ("rr_tp2", D), ("rr_tp3", D), ("plan_json", S))

SNAPSHOT_CACHE = _s(("id", L), ("exchange", S), ("ts", L), ("snapshot_json", S))

MARKET_CAP_CACHE = _s(("symbol", S), ("ts", L), ("market_cap", D))

ANALYSIS_RUNS = _s(("id", L), ("ts", L), ("window_days", L), ("exchange", S), ("top200_only", B), ("n_alerts", L))

CLEAN_UNIVERSE = _s(("exchange", S), ("symbol", S), ("interval", S), ("expected_ms", L), ("bars", L),
                    ("gap_bars", L), ("dup_bars", L), ("invalid_bars", L), ("gap_frac", D), ("dup_frac", D),
                    ("invalid_frac", D), ("min_open_time", L), ("max_open_time", L), ("min_open_dt_utc", TS),
                    ("max_open_dt_utc", TS), ("min_open_dt_syd", TS), ("max_open_dt_syd", TS))

PREDICTIONS = _s(("run_id", S), ("exchange", S), ("symbol", S), ("interval", S), ("entry_dt_utc", TS),
                 ("entry_dt_syd", TS), ("split", S), ("label", I), ("p_win", D), ("take_trade", I))

# Attributes a snapshot row may carry (all optional).
SNAPSHOT_ROW = _s(
    ("symbol", S), ("exchange", S), ("last_price", D), ("market_cap", D), ("liquidity_rank", L),
    ("liquidity_top200", B), ("signal_strength", S), ("mtf_summary", S), ("sector_tags", T.ArrayType(S)),
    ("change_1m", D), ("change_5m", D), ("change_15m", D), ("change_60m", D), ("vol_1m", D), ("vol_5m", D),
    ("vol_15m", D), ("rvol_1m", D), ("rsi_14", D), ("rsi_1h", D), ("rsi_4h", D), ("rsi_1d", D), ("macd", D),
    ("macd_1h", D), ("macd_4h", D), ("macd_1d", D), ("momentum_score", D), ("impulse_score", D),
    ("signal_score", D), ("volatility_percentile", D), ("open_interest", D), ("funding_rate", D),
)

TABLES = {
    "ohlc": OHLC, "alerts": ALERTS, "trade_plans": TRADE_PLANS, "snapshot_cache": SNAPSHOT_CACHE,
    "market_cap_cache": MARKET_CAP_CACHE, "analysis_runs": ANALYSIS_RUNS, "clean_universe": CLEAN_UNIVERSE,
    "predictions": PREDICTIONS,
}
