"""Technical indicators.

Window-only indicators are evaluated through ``series.halo_windows``;
recursive ones (EMA, Wilder RSI/ATR, ADX, MACD) through the exact blocked
scan ``series.ewm``.  Every function takes a bars frame with the standard
key and returns it with added columns (and ``bar_idx``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import series
from tidemark.operators import windows as W

def tr_expr():
    """True range; ``greatest`` skips NULLs, so the first bar is high - low."""
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("prev_close")),
                      F.abs(F.col("low") - F.col("prev_close")))


def indexed(bars: DataFrame) -> DataFrame:
    return bars if "bar_idx" in bars.columns else series.pinned(series.index_series(bars))


def div(a, b):
    return F.try_divide(a, b)


def ml_window_features(bars: DataFrame, atr_n: int = 14, fast: int = 20, slow: int = 50, hh_n: int = 20,
                       ll_n: int = 20, vol_n: int = 20) -> DataFrame:
    """I1-I4, I7, I15, I16 as in the ML notebook (partial windows at the start).

    ret_1, candle anatomy, true range (first bar = high - low), ATR-SMA,
    ATR%, SMA fast/slow + trend, prior-N HH/LL and ATR distances, return
    volatility, range/volume SMA, volume std and z-score.
    """
    d = indexed(bars)
    back = max(slow - 1, atr_n, hh_n, ll_n, vol_n) + 1

    def build(w):
        s1 = {"prev_close": F.lag("close").over(w)}
        s2 = {
            "ret_1": F.ln(div(F.col("close"), F.col("prev_close"))),
            "range": F.col("high") - F.col("low"),
            "body": F.abs(F.col("close") - F.col("open")),
            "upper_wick": F.col("high") - F.greatest("open", "close"),
            "lower_wick": F.least("open", "close") - F.col("low"),
            "gap": F.col("open") - F.col("prev_close"),
            "tr": tr_expr(),
        }
        s3 = {
            "body_to_range": F.when(F.col("range") > 0, div(F.col("body"), F.col("range"))),
            "atr": F.avg("tr").over(W.trailing(w, atr_n)),
            "sma_fast": F.avg("close").over(W.trailing(w, fast)),
            "sma_slow": F.avg("close").over(W.trailing(w, slow)),
            "hh_n": F.max("high").over(W.prior(w, hh_n)),
            "ll_n": F.min("low").over(W.prior(w, ll_n)),
            "ret_vol": F.stddev_samp("ret_1").over(W.trailing(w, vol_n)),
            "range_sma": F.avg("range").over(W.trailing(w, vol_n)),
            "vol_sma": F.avg("volume").over(W.trailing(w, vol_n)),
            "vol_std": F.stddev_samp("volume").over(W.trailing(w, vol_n)),
        }
        s4 = {
            "atrp": div(F.col("atr"), F.col("close")),
            "trend_up": (F.col("sma_fast") > F.col("sma_slow")).cast("int"),
            "trend_strength": div(F.col("sma_fast") - F.col("sma_slow"), F.col("atr")),
            "dist_to_hh_atr": div(F.col("close") - F.col("hh_n"), F.col("atr")),
            "dist_to_ll_atr": div(F.col("close") - F.col("ll_n"), F.col("atr")),
            "vol_z": F.when(F.col("vol_std") > 0, div(F.col("volume") - F.col("vol_sma"), F.col("vol_std"))),
        }
        return [s1, s2, s3, s4]

    return series.halo_windows(d, build, back=back)


def atr_sma(bars: DataFrame, n: int = 14, full: bool = True, out: str = "atr_14") -> DataFrame:
    """I4 (partial, ``full=False``) / I5 (strict ``min_periods=n``) ATR as SMA of TR."""
    d = indexed(bars)

    def build(w):
        return [{"prev_close": F.lag("close").over(w)}, {"tr": tr_expr()},
                {out: W.sma("tr", w, n, full=full)}]

    return series.halo_windows(d, build, back=n)


def ema(df: DataFrame, specs: list[tuple[str, int, str]], seed: str = "first") -> DataFrame:
    """I8: EMA span n (``adjust=False``).  ``seed='first'`` = pandas (first
    value), ``seed='sma'`` = chart built-in (SMA of the first n values)."""
    d = indexed(df)
    if seed == "first":
        return series.ewm(d, [(x, 2.0 / (n + 1), o) for x, n, o in specs])
    # SMA seed: feed NULL before the n-th value and the SMA at it.
    back = max(n for _, n, _ in specs)

    def build(w):
        return {f"_seed_{o}": F.when(F.col("bar_idx") == n - 1, F.avg(x).over(W.trailing(w, n)))
                .when(F.col("bar_idx") >= n, F.col(x)) for x, n, o in specs}

    d = series.halo_windows(d, build, back=back)
    d = series.ewm(d, [(f"_seed_{o}", 2.0 / (n + 1), o) for x, n, o in specs])
    return d.drop(*[f"_seed_{o}" for _, _, o in specs])


def atr_wilder(bars: DataFrame, n: int = 14, out: str = "atr_wilder") -> DataFrame:
    """Wilder ATR (RMA, alpha = 1/n) seeded with the SMA of the first n TRs."""
    d = indexed(bars)

    def build(w):
        return [{"prev_close": F.lag("close").over(w)}, {"tr": tr_expr()},
                {"_tr_seed": F.when(F.col("bar_idx") == n - 1, F.avg("tr").over(W.trailing(w, n)))
                 .when(F.col("bar_idx") >= n, F.col("tr"))}]

    d = series.halo_windows(d, build, back=n)
    return series.ewm(d, [("_tr_seed", 1.0 / n, out)]).drop("_tr_seed")


def _rsi(up, down):
    return (F.when(up.isNull() | down.isNull(), F.lit(None).cast("double"))
            .when((down == 0) & (up == 0), F.lit(None).cast("double"))
            .when(down == 0, F.lit(100.0))
            .otherwise(100.0 - 100.0 / (1.0 + up / down)))


def tech_features(bars: DataFrame, adx_n: int = 14, rsi_n: int = 14) -> DataFrame:
    """The notebook's per-symbol technical set: EMA20/50 and ratio (I8),
    Wilder RSI (I9), ADX (I11), MACD 12/26/9 (I12), Bollinger bandwidth (I13),
    Donchian position (I14) and 3/6/12-bar log momentum (I1)."""
    d = indexed(bars)

    def build(w):
        s1 = {"prev_close": F.lag("close").over(w), "prev_high": F.lag("high").over(w),
              "prev_low": F.lag("low").over(w),
              "mom_logret_3": F.ln(div(F.col("close"), F.lag("close", 3).over(w))),
              "mom_logret_6": F.ln(div(F.col("close"), F.lag("close", 6).over(w))),
              "mom_logret_12": F.ln(div(F.col("close"), F.lag("close", 12).over(w))),
              "_bb_mid": W.sma("close", w, 20), "_bb_sd": W.rolling_std("close", w, 20),
              "_hh20": W.rolling_max("high", w, 20), "_ll20": W.rolling_min("low", w, 20)}
        up_move = F.col("high") - F.col("prev_high")
        down_move = F.col("prev_low") - F.col("low")
        delta = F.col("close") - F.col("prev_close")
        s2 = {"tr": tr_expr(),
              "_pdm": F.when((up_move > down_move) & (up_move > 0), up_move).otherwise(F.lit(0.0)),
              "_mdm": F.when((down_move > up_move) & (down_move > 0), down_move).otherwise(F.lit(0.0)),
              "_up": F.greatest(delta, F.lit(0.0)),
              "_down": F.greatest(-delta, F.lit(0.0)),
              "bb_bw_20": div(4.0 * F.col("_bb_sd"), F.col("_bb_mid")),
              "donch_pos_20": div(F.col("close") - F.col("_ll20"), F.col("_hh20") - F.col("_ll20"))}
        return [s1, s2]

    d = series.halo_windows(d, build, back=20)
    # greatest() skips NULLs: restore NULL for the first delta.
    d = d.withColumns({"_up": F.when(F.col("prev_close").isNotNull(), F.col("_up")),
                       "_down": F.when(F.col("prev_close").isNotNull(), F.col("_down"))})
    a = 1.0 / rsi_n
    d = series.ewm(d, [("close", 2 / 21, "ema_20"), ("close", 2 / 51, "ema_50"), ("close", 2 / 13, "_ema12"),
                       ("close", 2 / 27, "_ema26"), ("_up", a, "_rup"), ("_down", a, "_rdown"),
                       ("tr", 1.0 / adx_n, "_atr_w"), ("_pdm", 1.0 / adx_n, "_spdm"),
                       ("_mdm", 1.0 / adx_n, "_smdm")])
    pdi = 100.0 * div(F.col("_spdm"), F.col("_atr_w"))
    mdi = 100.0 * div(F.col("_smdm"), F.col("_atr_w"))
    d = d.withColumns({"macd_line": F.col("_ema12") - F.col("_ema26"),
                       "_dx": div(100.0 * F.abs(pdi - mdi), pdi + mdi),
                       "ema_ratio": div(F.col("ema_20"), F.col("ema_50")),
                       "rsi_14": _rsi(F.col("_rup"), F.col("_rdown"))})
    d = series.ewm(d, [("macd_line", 2 / 10, "macd_signal"), ("_dx", 1.0 / adx_n, "adx_14")])
    d = d.withColumn("macd_hist", F.col("macd_line") - F.col("macd_signal"))
    return d.drop("_bb_mid", "_bb_sd", "_hh20", "_ll20", "_pdm", "_mdm", "_up", "_down", "_ema12", "_ema26",
                  "_rup", "_rdown", "_atr_w", "_spdm", "_smdm", "_dx", "prev_high", "prev_low")


def rsi_sma(bars: DataFrame, n: int = 14, out: str = "rsi_sma") -> DataFrame:
    """RSI with rolling-mean gains/losses (strict window)."""
    d = indexed(bars)

    def build(w):
        delta = F.col("close") - F.lag("close").over(w)
        s1 = {"_up": F.when(delta.isNotNull(), F.greatest(delta, F.lit(0.0))),
              "_down": F.when(delta.isNotNull(), F.greatest(-delta, F.lit(0.0)))}
        s2 = {out: _rsi(W.sma("_up", w, n), W.sma("_down", w, n))}
        return [s1, s2]

    return series.halo_windows(d, build, back=n + 1).drop("_up", "_down")


def daily_context(bars_1d: DataFrame) -> DataFrame:
    """1d context — SMA20/50 (strict), trend flag, 20-day return
    volatility, RSI-SMA(14), MACD histogram, ADX(14)."""
    d = indexed(bars_1d)

    def build(w):
        s1 = {"_ret": F.ln(div(F.col("close"), F.lag("close").over(w)))}
        s2 = {"sma_20d": W.sma("close", w, 20), "sma_50d": W.sma("close", w, 50),
              "ret_vol_20d": W.rolling_std("_ret", w, 20)}
        return [s1, s2]

    d = series.halo_windows(d, build, back=51)
    d = d.withColumn("trend_up_1d", F.coalesce((F.col("sma_20d") > F.col("sma_50d")).cast("int"), F.lit(0)))
    d = rsi_sma(d, 14, "rsi_14_1d")
    t = tech_features(d.select("exchange", "symbol", "interval", "bar_idx", "open_time", "open", "high", "low",
                               "close", "volume"))
    t = t.select("exchange", "symbol", "interval", "bar_idx", F.col("macd_hist").alias("macd_hist_1d"),
                 F.col("adx_14").alias("adx_14_1d"))
    return series._join(d.drop("_ret"), t, ["exchange", "symbol", "interval", "bar_idx"], "left")


def swing_context(bars: DataFrame, fast: int = 20, slow: int = 50, atr_n: int = 14, atr_sma_n: int = 20,
                  slope_bars: int = 5) -> DataFrame:
    """I18 + I19 (chart-script conventions: SMA-seeded EMAs and Wilder ATR).

    ema_slow_slope = EMA_slow - EMA_slow[5]; atr_decreasing over 3 bars;
    low_volatility = ATR < SMA20(ATR); regime up / down / ranging.
    """
    d = ema(indexed(bars), [("close", fast, "ema_fast"), ("close", slow, "ema_slow")], seed="sma")
    d = atr_wilder(d, atr_n, "atr_value")

    def build(w):
        return {"ema_slow_slope": F.col("ema_slow") - F.lag("ema_slow", slope_bars).over(w),
                "atr_decreasing": (F.col("atr_value") < F.lag("atr_value", 1).over(w))
                & (F.lag("atr_value", 1).over(w) < F.lag("atr_value", 2).over(w)),
                "atr_sma": W.sma("atr_value", w, atr_sma_n)}

    d = series.halo_windows(d, build, back=max(slope_bars, atr_sma_n))
    up = (F.col("ema_fast") > F.col("ema_slow")) & (F.col("ema_slow_slope") > 0)
    down = (F.col("ema_fast") < F.col("ema_slow")) & (F.col("ema_slow_slope") < 0)
    return d.withColumns({
        "low_volatility": F.col("atr_value") < F.col("atr_sma"),
        "trending_up": F.coalesce(up, F.lit(False)), "trending_down": F.coalesce(down, F.lit(False)),
        "regime": F.when(F.coalesce(up, F.lit(False)), "up").when(F.coalesce(down, F.lit(False)), "down")
                   .otherwise("ranging"),
    })


def volume_ratio(bars: DataFrame, n: int = 20, out: str = "vol_ratio") -> DataFrame:
    """Volume / SMA_n(volume) (strict window)."""
    d = indexed(bars)
    return series.halo_windows(d, lambda w: {out: div(F.col("volume"), W.sma("volume", w, n))}, back=n)


def momentum_features(bars: DataFrame, atr_n: int = 14, hh: int = 20, rank_n: int = 50) -> DataFrame:
    """pandas-starter features: log return, EMA20/50 + trend, strict ATR(14),
    ATR%, HH/HC/LL(20), volume SMA/z (I1, I5, I8, I16) and ATR% rank (I21)."""
    d = atr_sma(indexed(bars), atr_n, full=True, out="atr_14")
    d = ema(d, [("close", 20, "ema_20"), ("close", 50, "ema_50")])

    def build(w):
        s1 = {"ret_1": F.ln(F.col("close")) - F.ln(F.lag("close").over(w)),
              "trend_up": F.col("ema_20") > F.col("ema_50"),
              "atrp_14": div(F.col("atr_14"), F.col("close")),
              "hh_20": W.rolling_max("high", w, hh), "hc_20": W.rolling_max("close", w, hh),
              "ll_20": W.rolling_min("low", w, hh),
              "vol_sma_20": W.sma("volume", w, 20), "_vsd": W.rolling_std("volume", w, 20)}
        s2 = {"vol_z_20": div(F.col("volume") - F.col("vol_sma_20"), F.col("_vsd")),
              "atrp_rank_50": W.rolling_pct_rank("atrp_14", w, rank_n)}
        return [s1, s2]

    return series.halo_windows(d, build, back=rank_n + 1).drop("_vsd")
