"""Entry signals (G1-G5) as boolean columns on indicator frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import indicators as I
from tidemark.operators import series
from tidemark.operators import windows as W


def momentum_signals(bars: DataFrame) -> DataFrame:
    """G1 breakout (trend and close above the *prior* bar's HH20), G2 pullback
    reclaim of EMA20 within 0.5 ATR, G3 ATR% squeeze (rank < 0.25 on the prior
    bar, > 0.60 now) with a breakout.  Missing inputs give False."""
    d = I.momentum_features(bars)

    def build(w):
        prev_hh = F.lag("hh_20").over(w)
        near = F.abs(F.col("close") - F.col("ema_20")) <= 0.5 * F.col("atr_14")
        reclaim = (F.col("close") > F.col("ema_20")) & (F.lag("close").over(w) <= F.lag("ema_20").over(w))
        squeeze = (F.lag("atrp_rank_50").over(w) < 0.25) & (F.col("atrp_rank_50") > 0.60)
        brk = F.col("close") > prev_hh
        return {"sig_breakout_long": F.coalesce(F.col("trend_up") & brk, F.lit(False)),
                "sig_pullback_long": F.coalesce(F.col("trend_up") & near & reclaim, F.lit(False)),
                "sig_vol_squeeze_breakout": F.coalesce(squeeze & brk, F.lit(False))}

    return series.halo_windows(d, build, back=1)


def swing_setups(bars: DataFrame, use_vol_filter: bool = True, direction: str = "Both") -> DataFrame:
    """13-day swing setups.  In the pullback zone (close between the
    EMAs, trend agreeing) the run's lowest low / highest high is tracked
    (a run = consecutive in-zone bars, W9); setup = trend, in-zone extreme
    present, ATR falling 3 bars, close beyond the prior bar's high/low in
    the bar's direction, volatility filter."""
    d = I.swing_context(bars)
    zl = F.coalesce((F.col("close") > F.col("ema_slow")) & (F.col("close") < F.col("ema_fast"))
                    & F.col("trending_up"), F.lit(False))
    zs = F.coalesce((F.col("close") < F.col("ema_slow")) & (F.col("close") > F.col("ema_fast"))
                    & F.col("trending_down"), F.lit(False))
    d = d.withColumns({"in_zone_long": zl, "in_zone_short": zs})

    # Run ids need a running sum from the key start: do it as (block-local
    # running sum + carried offset) using the carry scan on run starts.
    def starts(w):
        return {"_start_l": F.col("in_zone_long") & ~F.coalesce(F.lag("in_zone_long").over(w), F.lit(False)),
                "_start_s": F.col("in_zone_short") & ~F.coalesce(F.lag("in_zone_short").over(w), F.lit(False)),
                "prev_high": F.lag("high").over(w), "prev_low": F.lag("low").over(w)}

    d = series.halo_windows(d, starts, back=1)
    d = d.withColumns({"_run_l": F.when(F.col("_start_l"), F.col("bar_idx")),
                       "_run_s": F.when(F.col("_start_s"), F.col("bar_idx"))})
    d = series.carry_last(d, ["_run_l", "_run_s"], key=("exchange", "symbol", "interval"), order=("bar_idx",))
    d = d.withColumns({"_seg_l": F.when(F.col("in_zone_long"), F.col("_run_l_carried")),
                       "_seg_s": F.when(F.col("in_zone_short"), F.col("_run_s_carried"))})
    # running extreme since the run start, only over in-zone rows (segmented scan, any run length)
    zl = series.segment_running(d.where(F.col("_seg_l").isNotNull()), "low", "_seg_l", "_pb_low", "min")
    zs = series.segment_running(d.where(F.col("_seg_s").isNotNull()), "high", "_seg_s", "_pb_high", "max")
    keys = ["exchange", "symbol", "interval", "bar_idx"]
    d = series._join(series._join(d, zl.select(*keys, "_pb_low"), keys, "left"), zs.select(*keys, "_pb_high"), keys, "left")
    vol_ok = F.lit(True) if not use_vol_filter else ~F.coalesce(F.col("low_volatility"), F.lit(False))
    long_ok = direction in ("Long Only", "Both")
    short_ok = direction in ("Short Only", "Both")
    d = d.withColumns({
        "pullback_low": F.when(F.col("in_zone_long"), F.col("_pb_low")),
        "pullback_high": F.when(F.col("in_zone_short"), F.col("_pb_high")),
    })
    d = d.withColumns({
        "long_setup": F.coalesce(F.lit(long_ok) & F.col("trending_up") & F.col("pullback_low").isNotNull()
                                 & F.col("atr_decreasing") & (F.col("close") > F.col("prev_high"))
                                 & (F.col("close") > F.col("open")) & vol_ok, F.lit(False)),
        "short_setup": F.coalesce(F.lit(short_ok) & F.col("trending_down") & F.col("pullback_high").isNotNull()
                                  & F.col("atr_decreasing") & (F.col("close") < F.col("prev_low"))
                                  & (F.col("close") < F.col("open")) & vol_ok, F.lit(False)),
    })
    return d.drop("_start_l", "_start_s", "_run_l", "_run_s", "_run_l_carried", "_run_s_carried", "_seg_l",
                  "_seg_s", "_pb_low", "_pb_high")


def regime_alerts(df: DataFrame) -> DataFrame:
    """Regime-change alerts (trend flag turns on) and entry alerts, one row
    per alert: a bar that raises several has several rows, one that raises none has none."""
    def build(w):
        return {"alert_trending_up": F.col("trending_up") & (F.col("trending_up") != F.lag("trending_up").over(w)),
                "alert_trending_down": F.col("trending_down")
                & (F.col("trending_down") != F.lag("trending_down").over(w))}

    d = series.halo_windows(df, build, back=1)
    d = d.withColumns({"alert_trending_up": F.coalesce("alert_trending_up", F.lit(False)),
                       "alert_trending_down": F.coalesce("alert_trending_down", F.lit(False))})
    named = [("trending_up", F.col("alert_trending_up")), ("trending_down", F.col("alert_trending_down"))]
    if "long_setup" in df.columns:
        named += [("long_entry", F.col("long_setup")), ("short_entry", F.col("short_setup"))]
    raised = F.filter(F.array(*[F.when(cond, F.lit(n)) for n, cond in named]), lambda x: x.isNotNull())
    return d.withColumn("alert", F.explode(raised))
