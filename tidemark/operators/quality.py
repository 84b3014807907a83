"""Data quality (D1-D8): bar integrity per key, clean universe, plan checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import num, safe_ratio
from tidemark.functions.timeutil import interval_ms, ms_to_utc, utc_to_local
from tidemark.operators import series
from tidemark.schemas import KEY


def bar_flags(bars: DataFrame) -> DataFrame:
    """Per bar: dt to the previous bar, gap/dup/invalid flags (uses a 1-row halo)."""
    d = series.index_series(bars.withColumn("expected_ms", interval_ms("interval")),
                            order=("open_time", "open", "high", "low", "close", "volume"))
    d = series.halo_windows(d, lambda w: {"prev_open_time": F.lag("open_time").over(w)}, back=1)
    dt = F.col("open_time") - F.col("prev_open_time")
    return d.withColumns({
        "dt": dt,
        "is_gap": F.col("prev_open_time").isNotNull() & (dt != F.col("expected_ms")),
        "is_dup": F.col("prev_open_time").isNotNull() & (dt == 0),
        "invalid_ohlc": (F.col("low") > F.col("high")) | (F.col("high") < F.greatest("open", "close"))
                        | (F.col("low") > F.least("open", "close")),
    })


def bar_quality(bars: DataFrame) -> DataFrame:
    """Bars, gap/dup/invalid counts and fractions, first/last open time.

    A duplicate bar also counts as a gap (dt = 0 differs from the interval).
    """
    q = (bar_flags(bars).groupBy(*KEY, "expected_ms")
         .agg(F.count(F.lit(1)).alias("bars"),
              F.count_if("is_gap").alias("gap_bars"), F.count_if("is_dup").alias("dup_bars"),
              F.count_if("invalid_ohlc").alias("invalid_bars"),
              F.min("open_time").alias("min_open_time"), F.max("open_time").alias("max_open_time")))
    return q.withColumns({
        "gap_frac": safe_ratio("gap_bars", "bars"),
        "dup_frac": safe_ratio("dup_bars", "bars"),
        "invalid_frac": safe_ratio("invalid_bars", "bars"),
    })


def clean_universe(quality: DataFrame, min_bars: int = 2000, max_gap_frac: float = 0.001,
                   max_dup_frac: float = 0.0001, max_invalid_frac: float = 0.0001,
                   tz: str = "Australia/Sydney") -> DataFrame:
    """Keys passing the quality thresholds, with UTC and local first/last times."""
    u = quality.where((F.col("bars") >= min_bars) & (F.col("gap_frac") <= max_gap_frac)
                      & (F.col("dup_frac") <= max_dup_frac) & (F.col("invalid_frac") <= max_invalid_frac))
    u = u.withColumns({"min_open_dt_utc": ms_to_utc("min_open_time"), "max_open_dt_utc": ms_to_utc("max_open_time")})
    u = u.withColumns({"min_open_dt_syd": utc_to_local("min_open_dt_utc", tz),
                       "max_open_dt_syd": utc_to_local("max_open_dt_utc", tz)})
    return u.select(*KEY, "expected_ms", "bars", "gap_bars", "dup_bars", "invalid_bars", "gap_frac", "dup_frac",
                    "invalid_frac", "min_open_time", "max_open_time", "min_open_dt_utc", "max_open_dt_utc",
                    "min_open_dt_syd", "max_open_dt_syd")


def column_coverage(df: DataFrame) -> DataFrame:
    """D3: per column non-null, null and non-null percent; most complete first."""
    n = F.count(F.lit(1))
    aggs = []
    for c in df.columns:
        aggs += [F.count(F.col(c)).alias(f"{c}__nn")]
    wide = df.agg(n.alias("__n"), *aggs)
    stack = ", ".join(f"'{c}', `{c}__nn`" for c in df.columns)
    long = wide.selectExpr("__n", f"stack({len(df.columns)}, {stack}) AS (column, non_null)")
    return long.select("column", "non_null", (F.col("__n") - F.col("non_null")).alias("null"),
                       F.round(F.try_divide(F.col("non_null") * 100.0, F.col("__n")), 6).alias("pct_non_null"))


def plan_side_checks(plans: DataFrame, missing_stop_is_wrong: bool = False) -> DataFrame:
    """Stop and take-profits on the correct side of entry per BUY/SELL.

    A missing TP is fine; a missing stop yields NULL (or ``False`` with the
    parity flag ``missing_stop_is_wrong``).
    """
    e, s = num("entry_price"), num("stop_loss")
    side = F.upper("side")
    buy, sell = side == "BUY", side == "SELL"
    stop_ok = F.when(buy, s < e).when(sell, s > e)
    if missing_stop_is_wrong:
        stop_ok = F.coalesce(stop_ok, F.lit(False))
    out = {"stop_ok": stop_ok}
    for tp in ("tp1", "tp2", "tp3"):
        t = num(tp)
        out[f"{tp}_ok"] = F.when(t.isNull(), F.lit(True)).when(buy, t > e).when(sell, t < e)
    return plans.withColumns(out)


def plan_side_summary(plans: DataFrame) -> DataFrame:
    """D4 summary per side: plans and wrong-side counts."""
    c = plan_side_checks(plans)
    return (c.groupBy(F.upper("side").alias("side"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("stop_ok")).alias("stop_wrong"),
                 F.count_if(F.col("stop_ok").isNull()).alias("stop_unknown"),
                 F.count_if(~F.col("tp1_ok")).alias("tp1_wrong"), F.count_if(~F.col("tp2_ok")).alias("tp2_wrong"),
                 F.count_if(~F.col("tp3_ok")).alias("tp3_wrong")))


def plan_risk_checks(plans: DataFrame, min_risk: float = 1e-9, lo: float = 0.5, hi: float = 2.0,
                     max_atr_mult: float = 50.0, max_rr: float = 50.0) -> DataFrame:
    """D5 + D6: missing entry/stop, zero or tiny risk, risk ratio outside
    [lo, hi], outlier ATR multiple and reward:risk; one summary row."""
    e, s, r = num("entry_price"), num("stop_loss"), num("risk_per_unit")
    dist = F.abs(e - s)
    ratio = F.try_divide(r, dist)
    return plans.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(e.isNull()).alias("missing_entry"), F.count_if(s.isNull()).alias("missing_stop"),
        F.count_if(dist <= F.lit(min_risk)).alias("zero_risk"),
        F.count_if((ratio < lo) | (ratio > hi)).alias("risk_ratio_out"),
        F.count_if(num("atr_mult") > max_atr_mult).alias("atr_mult_outliers"),
        F.count_if((num("rr_tp1") > max_rr) | (num("rr_tp2") > max_rr) | (num("rr_tp3") > max_rr)).alias("rr_outliers"),
    )


def offending_plans(plans: DataFrame, n: int = 20, lo: float = 0.5, hi: float = 2.0) -> DataFrame:
    """First ``n`` plans (by id) failing a side or risk-ratio check."""
    c = plan_side_checks(plans)
    ratio = F.try_divide(num("risk_per_unit"), F.abs(num("entry_price") - num("stop_loss")))
    bad = (~F.coalesce(F.col("stop_ok"), F.lit(True))) | (~F.col("tp1_ok")) | (~F.col("tp2_ok")) \
        | (~F.col("tp3_ok")) | (ratio < lo) | (ratio > hi)
    return (c.where(bad).orderBy("id").limit(n)
            .select("id", "symbol", "side", "entry_price", "stop_loss", "tp1", "risk_per_unit", "stop_ok", "tp1_ok"))
