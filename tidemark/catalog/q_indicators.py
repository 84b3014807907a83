"""Registered queries: windows (W*), indicators (I*) and signals (G*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import sqlsrc
from tidemark.catalog.common import bars_all
from tidemark.operators import indicators as I
from tidemark.operators import series
from tidemark.operators import signals as G
from tidemark.operators import windows as W

QUERIES, SQL = {}, {}
K = ["exchange", "symbol", "interval"]
KS = "exchange, symbol, interval"


def rnd(df, cols, n=6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) for c in cols})


def sel(df, cols, extra=()):
    return rnd(df.select(*K, "open_time", *extra, *cols), cols)


IDX_CTE = (f"WITH bars AS ({sqlsrc.bars_all()}), "
           f"b AS (SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY open_time) - 1 AS bar_idx FROM bars)")
WIN = f"WINDOW w AS (PARTITION BY {KS} ORDER BY bar_idx)"


def rows(n):
    return f"(w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def strict_sql(agg, x, n):
    return f"CASE WHEN count({x}) OVER {rows(n)} >= {n} THEN {agg}({x}) OVER {rows(n)} END"


def r(x):
    return sqlsrc.rnd(x)


# ---------------------------------------------------------------- W1, W2

def w2_bar_index(spark, sf):
    return series.index_series(bars_all(spark, sf)).select(*K, "open_time", "bar_idx")


def w2_odd_labels(spark, sf):
    """Bars whose interval label is unknown to the map, or NULL, and bars that share a time: all keep their place,
    and scans over them (running volume, smoothed close) are those of their own series."""
    from tidemark.sources import adapters as A
    b = A.bars_events(spark, sf, "1h")
    k = F.pmod(F.floor(F.col("open_time") / 3_600_000), F.lit(3))
    b = b.withColumn("interval", F.when(k == 0, "1w").when(k == 2, F.col("interval")))
    b = b.unionByName(b.where("volume >= 5").withColumn("close", F.col("close") + 1))
    d = series.index_series(b)
    d = series.running_sum(d, "volume", "volume_so_far")
    d = series.ewm(d, [("close", 1.0, "last_close")])
    return rnd(d.select(*K, "open_time", "bar_idx", "volume_so_far", "last_close"), ["volume_so_far", "last_close"])


def _w2_odd_sql():
    return f"""WITH e AS ({sqlsrc.bars_events('1h')}),
l AS (SELECT * REPLACE (CASE (open_time // 3600000) % 3 WHEN 0 THEN '1w' WHEN 1 THEN NULL ELSE interval END AS interval) FROM e),
b AS (SELECT * FROM l UNION ALL SELECT * REPLACE (close + 1 AS close) FROM l WHERE volume >= 5)
SELECT {KS}, open_time, row_number() OVER w - 1 AS bar_idx, {r('sum(volume) OVER (w ROWS UNBOUNDED PRECEDING)')} AS volume_so_far,
  {r('close')} AS last_close
FROM b WINDOW w AS (PARTITION BY {KS} ORDER BY open_time, close_time, open, high, low, close, volume)"""


SQL["w2_odd_labels"] = _w2_odd_sql()
SQL["w2_bar_index"] = IDX_CTE + f" SELECT {KS}, open_time, bar_idx FROM b"


def w1_lag_lead(spark, sf):
    d = W.lag_lead(series.index_series(bars_all(spark, sf)),
                   {"prev_close": ("close", 1), "prev_open_time": ("open_time", 1), "close_lead_3": ("close", -3)})
    return d.select(*K, "open_time", "prev_close", "prev_open_time", "close_lead_3")


SQL["w1_lag_lead"] = IDX_CTE + f""" SELECT {KS}, open_time, lag(close) OVER w AS prev_close,
  lag(open_time) OVER w AS prev_open_time, lead(close, 3) OVER w AS close_lead_3 FROM b {WIN}"""


# ------------------------------------------------------------ W4-W7, W9-W11

def w4_w6_rolling(spark, sf):
    d = series.index_series(bars_all(spark, sf))

    def build(w):
        return {"sma_close_20_partial": W.sma("close", w, 20, full=False),
                "sma_close_20_full": W.sma("close", w, 20, full=True),
                "std_close_20": W.rolling_std("close", w, 20),
                "max_high_20": W.rolling_max("high", w, 20, full=False),
                "min_low_20_full": W.rolling_min("low", w, 20),
                "prior_max_high_10": F.max("high").over(W.prior(w, 10)),
                "prior_min_low_10": F.min("low").over(W.prior(w, 10))}

    cols = ["sma_close_20_partial", "sma_close_20_full", "std_close_20", "max_high_20", "min_low_20_full",
            "prior_max_high_10", "prior_min_low_10"]
    return sel(series.halo_windows(d, build, back=20), cols)


SQL["w4_w6_rolling"] = IDX_CTE + f""" SELECT {KS}, open_time,
  {r(f"avg(close) OVER {rows(20)}")} AS sma_close_20_partial,
  {r(strict_sql("avg", "close", 20))} AS sma_close_20_full,
  {r(strict_sql("stddev_samp", "close", 20))} AS std_close_20,
  {r(f"max(high) OVER {rows(20)}")} AS max_high_20,
  {r(strict_sql("min", "low", 20))} AS min_low_20_full,
  {r("max(high) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)")} AS prior_max_high_10,
  {r("min(low) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)")} AS prior_min_low_10
FROM b {WIN}"""


def w7_pct_rank(spark, sf):
    d = series.index_series(bars_all(spark, sf))
    d = series.halo_windows(d, lambda w: {"close_rank_50": W.rolling_pct_rank("close", w, 50)}, back=50)
    return sel(d, ["close_rank_50"])


SQL["w7_pct_rank"] = IDX_CTE + f""", q AS (SELECT *, list(close) OVER {rows(50)} AS vals FROM b {WIN})
SELECT {KS}, open_time,
  {r("""CASE WHEN len(vals) >= 50 THEN (len(list_filter(vals, lambda v: v < close))
        + (len(list_filter(vals, lambda v: v = close)) + 1) / 2.0) / len(vals) END""")} AS close_rank_50
FROM q"""


def w9_runs(spark, sf):
    """Run id of consecutive up-closes (gaps and islands) and run length."""
    d = series.index_series(bars_all(spark, sf)).withColumn("up", F.col("close") >= F.col("open"))
    # run starts carried forward = segmented scan, no whole-key window
    d = series.halo_windows(d, lambda w: {"_start": F.coalesce(F.col("up") != F.lag("up").over(w), F.lit(True))},
                            back=1)
    d = d.withColumn("_s", F.when(F.col("_start"), F.col("bar_idx")))
    d = series.carry_last(d, ["_s"], key=K, order=("bar_idx",))
    d = d.withColumns({"run_start_idx": F.col("_s_carried"),
                       "run_pos": F.col("bar_idx") - F.col("_s_carried") + 1})
    return d.select(*K, "open_time", "up", "run_start_idx", "run_pos")


SQL["w9_runs"] = IDX_CTE + f""", s AS (SELECT *, close >= open AS up,
   coalesce((close >= open) <> lag(close >= open) OVER w, TRUE) AS st FROM b {WIN}),
g AS (SELECT *, sum(CAST(st AS INT)) OVER (PARTITION BY {KS} ORDER BY bar_idx ROWS UNBOUNDED PRECEDING) AS grp FROM s)
SELECT {KS}, open_time, up, min(bar_idx) OVER (PARTITION BY {KS}, grp) AS run_start_idx,
       bar_idx - min(bar_idx) OVER (PARTITION BY {KS}, grp) + 1 AS run_pos FROM g"""


def w10_qcut(spark, sf):
    """Five equal-count buckets of ATR% per key (pandas qcut on the whole series)."""
    d = I.atr_sma(bars_all(spark, sf), 14, full=True, out="atr_14")
    d = d.withColumn("atrp", F.try_divide(F.col("atr_14"), F.col("close")))
    edges = W.qcut_edges(d, "atrp", 5)
    d = d.join(edges, K).withColumn("atrp_bucket", W.qcut_bucket("atrp", F.col("_edges"), 5))
    return d.select(*K, "open_time", "atrp_bucket")


SQL["w10_qcut"] = IDX_CTE + f""", t AS (SELECT *, greatest(high - low, abs(high - lag(close) OVER w),
       abs(low - lag(close) OVER w)) AS tr FROM b {WIN}),
a AS (SELECT *, {strict_sql("avg", "tr", 14)} / close AS atrp FROM t {WIN}),
e AS (SELECT {KS}, quantile_cont(atrp, [0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS ed FROM a GROUP BY ALL)
SELECT a.exchange, a.symbol, a.interval, open_time,
  CASE WHEN len(list_distinct(ed)) = len(ed) THEN
    CASE WHEN atrp >= ed[1] AND atrp <= ed[2] THEN 0 WHEN atrp > ed[2] AND atrp <= ed[3] THEN 1
         WHEN atrp > ed[3] AND atrp <= ed[4] THEN 2 WHEN atrp > ed[4] AND atrp <= ed[5] THEN 3
         WHEN atrp > ed[5] AND atrp <= ed[6] THEN 4 END END AS atrp_bucket
FROM a JOIN e USING ({KS})"""


def w11_local_extremes(spark, sf):
    d = series.index_series(bars_all(spark, sf))
    d = series.halo_windows(d, lambda w: {"is_swing_high": W.strict_local_max("high", w, 5, 5),
                                          "is_swing_low": W.strict_local_min("low", w, 5, 5)}, back=5, fwd=5)
    return d.select(*K, "open_time", "is_swing_high", "is_swing_low")


SQL["w11_local_extremes"] = IDX_CTE + f""" SELECT {KS}, open_time,
  count(high) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) = 5
   AND count(high) OVER (w ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) = 5
   AND high > max(high) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
   AND high > max(high) OVER (w ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS is_swing_high,
  count(low) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) = 5
   AND count(low) OVER (w ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) = 5
   AND low < min(low) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
   AND low < min(low) OVER (w ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS is_swing_low
FROM b {WIN}"""


# ---------------------------------------------------------------- indicators

ML_COLS = ["prev_close", "ret_1", "range", "body", "upper_wick", "lower_wick", "body_to_range", "gap", "tr", "atr",
           "atrp", "sma_fast", "sma_slow", "trend_up", "trend_strength", "hh_n", "ll_n", "dist_to_hh_atr",
           "dist_to_ll_atr", "ret_vol", "range_sma", "vol_sma", "vol_std", "vol_z"]


# Windowed means of cent-grid prices can sit exactly on a 6-decimal tie
# (e.g. a 32-row partial mean); 8 decimals is tie-free for windows <= 50.
MEAN8 = ["atr", "sma_fast", "sma_slow", "range_sma", "vol_sma"]


def i_ml_features(spark, sf):
    d = I.ml_window_features(bars_all(spark, sf))
    d = rnd(d, MEAN8, 8)
    return sel(d, [c for c in ML_COLS if c not in MEAN8 and c != "trend_up"], extra=["trend_up", *MEAN8])


def _nz(x):
    return f"CASE WHEN ({x}) <> 0 THEN "


SQL["i_ml_features"] = IDX_CTE + f""",
s1 AS (SELECT *, lag(close) OVER w AS prev_close FROM b {WIN}),
s2 AS (SELECT *, CASE WHEN prev_close <> 0 THEN ln(close / prev_close) END AS ret_1, high - low AS range,
          abs(close - open) AS body, high - greatest(open, close) AS upper_wick, least(open, close) - low AS lower_wick,
          open - prev_close AS gap,
          CASE WHEN prev_close IS NULL THEN high - low
               ELSE greatest(high - low, abs(high - prev_close), abs(low - prev_close)) END AS tr FROM s1),
s3 AS (SELECT *, CASE WHEN range > 0 THEN body / range END AS body_to_range,
          avg(tr) OVER {rows(14)} AS atr, avg(close) OVER {rows(20)} AS sma_fast, avg(close) OVER {rows(50)} AS sma_slow,
          max(high) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS hh_n,
          min(low) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS ll_n,
          stddev_samp(ret_1) OVER {rows(20)} AS ret_vol, avg(range) OVER {rows(20)} AS range_sma,
          avg(volume) OVER {rows(20)} AS vol_sma, stddev_samp(volume) OVER {rows(20)} AS vol_std FROM s2 {WIN})
SELECT {KS}, open_time, {r("prev_close")} AS prev_close, {r("ret_1")} AS ret_1, {r("range")} AS range,
  {r("body")} AS body, {r("upper_wick")} AS upper_wick, {r("lower_wick")} AS lower_wick,
  {r("body_to_range")} AS body_to_range, {r("gap")} AS gap, {r("tr")} AS tr, {sqlsrc.rnd("atr", 8)} AS atr,
  {r(_nz("close") + "atr / close END")} AS atrp, {sqlsrc.rnd("sma_fast", 8)} AS sma_fast, {sqlsrc.rnd("sma_slow", 8)} AS sma_slow,
  CAST(sma_fast > sma_slow AS INT) AS trend_up,
  {r(_nz("atr") + "(sma_fast - sma_slow) / atr END")} AS trend_strength, {r("hh_n")} AS hh_n, {r("ll_n")} AS ll_n,
  {r(_nz("atr") + "(close - hh_n) / atr END")} AS dist_to_hh_atr,
  {r(_nz("atr") + "(close - ll_n) / atr END")} AS dist_to_ll_atr,
  {r("ret_vol")} AS ret_vol, {sqlsrc.rnd("range_sma", 8)} AS range_sma, {sqlsrc.rnd("vol_sma", 8)} AS vol_sma, {r("vol_std")} AS vol_std,
  {r("CASE WHEN vol_std > 0 THEN (volume - vol_sma) / vol_std END")} AS vol_z
FROM s3"""


def i5_atr_full(spark, sf):
    return sel(I.atr_sma(bars_all(spark, sf), 14, full=True, out="atr_14"), ["atr_14"])


SQL["i5_atr_full"] = IDX_CTE + f""", t AS (SELECT *, CASE WHEN lag(close) OVER w IS NULL THEN high - low ELSE
  greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) END AS tr FROM b {WIN})
SELECT {KS}, open_time, {r(strict_sql("avg", "tr", 14))} AS atr_14 FROM t {WIN}"""


def ewm_expr(x: str, alpha: float, seed: int, xs_col: str) -> str:
    q = 1.0 - alpha
    return (f"(CASE WHEN bar_idx >= {seed} THEN pow({q!r}, bar_idx - {seed}) * {xs_col} + pow({q!r}, bar_idx) * "
            f"sum(CASE WHEN bar_idx > {seed} THEN {alpha!r} * {x} * pow({q!r}, -bar_idx) ELSE 0 END) "
            f"OVER (PARTITION BY {KS} ORDER BY bar_idx ROWS UNBOUNDED PRECEDING) END)")


def _seed_col(x: str, seed: int, name: str) -> str:
    return f"max(CASE WHEN bar_idx = {seed} THEN {x} END) OVER (PARTITION BY {KS}) AS {name}"


def i8_ema(spark, sf):
    d = I.ema(bars_all(spark, sf), [("close", 20, "ema_20"), ("close", 50, "ema_50")])
    d = d.withColumn("ema_ratio", F.try_divide(F.col("ema_20"), F.col("ema_50")))
    return sel(d, ["ema_20", "ema_50", "ema_ratio"])


SQL["i8_ema"] = IDX_CTE + f""", s AS (SELECT *, {_seed_col("close", 0, "x0")} FROM b),
e AS (SELECT *, {ewm_expr("close", 2 / 21, 0, "x0")} AS ema_20, {ewm_expr("close", 2 / 51, 0, "x0")} AS ema_50 FROM s)
SELECT {KS}, open_time, {r("ema_20")} AS ema_20, {r("ema_50")} AS ema_50, {r("ema_20 / ema_50")} AS ema_ratio FROM e"""


def i9_i12_rsi_macd(spark, sf):
    d = I.tech_features(bars_all(spark, sf))
    return sel(d, ["rsi_14", "macd_line", "macd_signal", "macd_hist"])


SQL["i9_i12_rsi_macd"] = IDX_CTE + f""",
d AS (SELECT *, greatest(close - lag(close) OVER w, 0) AS up, greatest(lag(close) OVER w - close, 0) AS dn FROM b {WIN}),
s AS (SELECT *, {_seed_col("close", 0, "x0")}, {_seed_col("up", 1, "u1")}, {_seed_col("dn", 1, "d1")} FROM d),
e AS (SELECT *, {ewm_expr("close", 2 / 13, 0, "x0")} - {ewm_expr("close", 2 / 27, 0, "x0")} AS macd_line,
             {ewm_expr("up", 1 / 14, 1, "u1")} AS rup, {ewm_expr("dn", 1 / 14, 1, "d1")} AS rdn FROM s),
m AS (SELECT *, {_seed_col("macd_line", 0, "m0")} FROM e),
f AS (SELECT *, {ewm_expr("macd_line", 2 / 10, 0, "m0")} AS macd_signal FROM m)
SELECT {KS}, open_time,
  {r("CASE WHEN rup IS NULL OR rdn IS NULL THEN NULL WHEN rdn = 0 AND rup = 0 THEN NULL WHEN rdn = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + rup / rdn) END")} AS rsi_14,
  {r("macd_line")} AS macd_line, {r("macd_signal")} AS macd_signal, {r("macd_line - macd_signal")} AS macd_hist
FROM f"""


def i10_rsi_sma(spark, sf):
    return sel(I.rsi_sma(bars_all(spark, sf), 14, "rsi_sma_14"), ["rsi_sma_14"])


SQL["i10_rsi_sma"] = IDX_CTE + f""",
d AS (SELECT *, CASE WHEN lag(close) OVER w IS NOT NULL THEN greatest(close - lag(close) OVER w, 0) END AS up,
  CASE WHEN lag(close) OVER w IS NOT NULL THEN greatest(lag(close) OVER w - close, 0) END AS dn FROM b {WIN}),
m AS (SELECT *, {strict_sql("avg", "up", 14)} AS ru, {strict_sql("avg", "dn", 14)} AS rd FROM d {WIN})
SELECT {KS}, open_time, {r("CASE WHEN ru IS NULL OR rd IS NULL THEN NULL WHEN rd = 0 AND ru = 0 THEN NULL WHEN rd = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + ru / rd) END")} AS rsi_sma_14
FROM m"""


def i13_i14_bands(spark, sf):
    d = I.tech_features(bars_all(spark, sf))
    return sel(d, ["bb_bw_20", "donch_pos_20", "mom_logret_3", "mom_logret_6", "mom_logret_12"])


SQL["i13_i14_bands"] = IDX_CTE + f""", m AS (SELECT *, {strict_sql("avg", "close", 20)} AS mid,
  {strict_sql("stddev_samp", "close", 20)} AS sd, {strict_sql("max", "high", 20)} AS hh,
  {strict_sql("min", "low", 20)} AS ll, lag(close, 3) OVER w AS c3, lag(close, 6) OVER w AS c6,
  lag(close, 12) OVER w AS c12 FROM b {WIN})
SELECT {KS}, open_time, {r("CASE WHEN mid <> 0 THEN 4.0 * sd / mid END")} AS bb_bw_20,
  {r("CASE WHEN hh - ll <> 0 THEN (close - ll) / (hh - ll) END")} AS donch_pos_20,
  {r("ln(close / c3)")} AS mom_logret_3, {r("ln(close / c6)")} AS mom_logret_6, {r("ln(close / c12)")} AS mom_logret_12
FROM m"""


def i20_volume_ratio(spark, sf):
    return sel(I.volume_ratio(bars_all(spark, sf), 20, "vol_ratio"), ["vol_ratio"])


SQL["i20_volume_ratio"] = IDX_CTE + f""" SELECT {KS}, open_time,
  {r(f"CASE WHEN ({strict_sql('avg', 'volume', 20)}) <> 0 THEN volume / ({strict_sql('avg', 'volume', 20)}) END")} AS vol_ratio
FROM b {WIN}"""


def i21_atrp_rank(spark, sf):
    d = I.momentum_features(bars_all(spark, sf))
    return sel(d, ["atr_14", "atrp_14", "atrp_rank_50", "hh_20", "hc_20", "ll_20", "vol_sma_20", "vol_z_20"])


SQL["i21_atrp_rank"] = IDX_CTE + f""", t AS (SELECT *, CASE WHEN lag(close) OVER w IS NULL THEN high - low ELSE
  greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) END AS tr FROM b {WIN}),
a AS (SELECT *, {strict_sql("avg", "tr", 14)} AS atr_14 FROM t {WIN}),
p AS (SELECT *, atr_14 / close AS atrp_14 FROM a),
q AS (SELECT *, list(atrp_14) OVER {rows(50)} AS vals, {strict_sql("max", "high", 20)} AS hh_20,
  {strict_sql("max", "close", 20)} AS hc_20, {strict_sql("min", "low", 20)} AS ll_20,
  {strict_sql("avg", "volume", 20)} AS vol_sma_20, {strict_sql("stddev_samp", "volume", 20)} AS vsd FROM p {WIN})
SELECT {KS}, open_time, {r("atr_14")} AS atr_14, {r("atrp_14")} AS atrp_14,
  {r("""CASE WHEN atrp_14 IS NOT NULL AND len(list_filter(vals, lambda v: v IS NOT NULL)) >= 50 THEN
    (len(list_filter(vals, lambda v: v < atrp_14)) + (len(list_filter(vals, lambda v: v = atrp_14)) + 1) / 2.0)
    / len(list_filter(vals, lambda v: v IS NOT NULL)) END""")} AS atrp_rank_50,
  {r("hh_20")} AS hh_20, {r("hc_20")} AS hc_20, {r("ll_20")} AS ll_20, {r("vol_sma_20")} AS vol_sma_20,
  {r("CASE WHEN vsd <> 0 THEN (volume - vol_sma_20) / vsd END")} AS vol_z_20
FROM q"""


# ----------------------------------------------- R-checked (recursive chains)

def i6_atr_wilder(spark, sf):
    # 4 decimals: the SQL closed form carries ~1e-16 relative error on 1e5-sized prices
    return rnd(I.atr_wilder(bars_all(spark, sf), 14, "atr_wilder").select(*K, "open_time", "atr_wilder"),
               ["atr_wilder"], 4)


def i11_adx(spark, sf):
    d = I.tech_features(bars_all(spark, sf))
    return rnd(sel(d, ["ema_ratio"], extra=["adx_14"]), ["adx_14"], 4)


def i17_daily_context(spark, sf):
    d = I.daily_context(bars_all(spark, sf).where(F.col("interval") == "1d"))
    d = sel(d, ["sma_20d", "sma_50d", "ret_vol_20d", "rsi_14_1d"], extra=["trend_up_1d", "macd_hist_1d", "adx_14_1d"])
    return rnd(d, ["macd_hist_1d", "adx_14_1d"], 4)


def i18_i19_swing_context(spark, sf):
    d = I.swing_context(bars_all(spark, sf))
    cols = ["ema_fast", "ema_slow", "ema_slow_slope", "atr_value", "atr_sma"]
    return rnd(d.select(*K, "open_time", "atr_decreasing", "low_volatility", "regime", *cols), cols, 4)


def g1_g3_momentum_signals(spark, sf):
    d = G.momentum_signals(bars_all(spark, sf))
    return d.select(*K, "open_time", "sig_breakout_long", "sig_pullback_long", "sig_vol_squeeze_breakout")


def swing_setups_shared(spark, sf):
    from tidemark.catalog.common import shared
    return shared(spark, sf, "swing_setups", lambda: G.swing_setups(bars_all(spark, sf)))


def g4_swing_setups(spark, sf):
    d = swing_setups_shared(spark, sf)
    return sel(d, ["pullback_low", "pullback_high"], extra=["in_zone_long", "in_zone_short", "long_setup",
                                                            "short_setup"])


def g5_regime_alerts(spark, sf):
    d = G.regime_alerts(swing_setups_shared(spark, sf))
    return d.select(*K, "open_time", "alert")


for _n, _f in list(globals().items()):
    if callable(_f) and _n[:1] in "wig" and _n[1:2].isdigit() or _n == "i_ml_features":
        QUERIES[_n] = _f


SQL["i6_atr_wilder"] = IDX_CTE + f""", t AS (SELECT *, CASE WHEN lag(close) OVER w IS NULL THEN high - low ELSE
  greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) END AS tr FROM b {WIN}),
s AS (SELECT *, avg(tr) OVER {rows(14)} AS sma14 FROM t {WIN}),
x AS (SELECT *, {_seed_col("sma14", 13, "x13")} FROM s)
SELECT {KS}, open_time, {sqlsrc.rnd(ewm_expr("tr", 1 / 14, 13, "x13"), 4)} AS atr_wilder FROM x"""


SQL["g1_g3_momentum_signals"] = IDX_CTE + f""", t AS (SELECT *, CASE WHEN lag(close) OVER w IS NULL THEN high - low ELSE
  greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) END AS tr FROM b {WIN}),
a AS (SELECT *, {strict_sql("avg", "tr", 14)} AS atr_14, {strict_sql("max", "high", 20)} AS hh_20 FROM t {WIN}),
s AS (SELECT *, {_seed_col("close", 0, "x0")}, atr_14 / close AS atrp_14 FROM a),
e AS (SELECT *, {ewm_expr("close", 2 / 21, 0, "x0")} AS ema_20, {ewm_expr("close", 2 / 51, 0, "x0")} AS ema_50 FROM s),
q AS (SELECT *, list(atrp_14) OVER {rows(50)} AS vals FROM e {WIN}),
k AS (SELECT *, CASE WHEN atrp_14 IS NOT NULL AND len(list_filter(vals, lambda v: v IS NOT NULL)) >= 50 THEN
    (len(list_filter(vals, lambda v: v < atrp_14)) + (len(list_filter(vals, lambda v: v = atrp_14)) + 1) / 2.0)
    / len(list_filter(vals, lambda v: v IS NOT NULL)) END AS rk FROM q),
f AS (SELECT *, ema_20 > ema_50 AS trend_up, close > lag(hh_20) OVER w AS brk,
        abs(close - ema_20) <= 0.5 * atr_14 AS near,
        close > ema_20 AND lag(close) OVER w <= lag(ema_20) OVER w AS reclaim,
        lag(rk) OVER w < 0.25 AND rk > 0.60 AS squeeze FROM k {WIN})
SELECT {KS}, open_time, coalesce(trend_up AND brk, FALSE) AS sig_breakout_long,
  coalesce(trend_up AND near AND reclaim, FALSE) AS sig_pullback_long,
  coalesce(squeeze AND brk, FALSE) AS sig_vol_squeeze_breakout FROM f"""


SQL["i18_i19_swing_context"] = IDX_CTE + f""", t AS (SELECT *, CASE WHEN lag(close) OVER w IS NULL THEN high - low ELSE
  greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) END AS tr FROM b {WIN}),
s AS (SELECT *, avg(tr) OVER {rows(14)} AS sma_tr, avg(close) OVER {rows(20)} AS sma_c20,
        avg(close) OVER {rows(50)} AS sma_c50 FROM t {WIN}),
x AS (SELECT *, {_seed_col("sma_tr", 13, "x13")}, {_seed_col("sma_c20", 19, "x19")}, {_seed_col("sma_c50", 49, "x49")} FROM s),
e AS (SELECT *, {ewm_expr("close", 2 / 21, 19, "x19")} AS ema_fast, {ewm_expr("close", 2 / 51, 49, "x49")} AS ema_slow,
        {ewm_expr("tr", 1 / 14, 13, "x13")} AS atr_value FROM x),
f AS (SELECT *, ema_slow - lag(ema_slow, 5) OVER w AS ema_slow_slope,
        atr_value < lag(atr_value, 1) OVER w AND lag(atr_value, 1) OVER w < lag(atr_value, 2) OVER w AS atr_decreasing,
        {strict_sql("avg", "atr_value", 20)} AS atr_sma FROM e {WIN}),
g AS (SELECT *, coalesce(ema_fast > ema_slow AND ema_slow_slope > 0, FALSE) AS up,
        coalesce(ema_fast < ema_slow AND ema_slow_slope < 0, FALSE) AS down FROM f)
SELECT {KS}, open_time, atr_decreasing, atr_value < atr_sma AS low_volatility,
  CASE WHEN up THEN 'up' WHEN down THEN 'down' ELSE 'ranging' END AS regime,
  {sqlsrc.rnd("ema_fast", 4)} AS ema_fast, {sqlsrc.rnd("ema_slow", 4)} AS ema_slow,
  {sqlsrc.rnd("ema_slow_slope", 4)} AS ema_slow_slope, {sqlsrc.rnd("atr_value", 4)} AS atr_value,
  {sqlsrc.rnd("atr_sma", 4)} AS atr_sma FROM g"""


def ewm_col(x: str, alpha: float, seed_col: str, xs_col: str) -> str:
    """Closed-form smoothing seeded at a per-key bar index column."""
    q = 1.0 - alpha
    return (f"(CASE WHEN bar_idx >= {seed_col} THEN pow({q!r}, bar_idx - {seed_col}) * {xs_col} + pow({q!r}, bar_idx) * "
            f"sum(CASE WHEN bar_idx > {seed_col} THEN {alpha!r} * {x} * pow({q!r}, -bar_idx) ELSE 0 END) "
            f"OVER (PARTITION BY {KS} ORDER BY bar_idx ROWS UNBOUNDED PRECEDING) END)")


SQL["i11_adx"] = IDX_CTE + f""",
m AS (SELECT *, lag(close) OVER w AS pc, high - lag(high) OVER w AS upm, lag(low) OVER w - low AS dnm FROM b {WIN}),
t AS (SELECT *, CASE WHEN pc IS NULL THEN high - low ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr,
        CASE WHEN upm > dnm AND upm > 0 THEN upm ELSE 0.0 END AS pdm,
        CASE WHEN dnm > upm AND dnm > 0 THEN dnm ELSE 0.0 END AS mdm FROM m),
s AS (SELECT *, {_seed_col("tr", 0, "tr0")}, {_seed_col("pdm", 0, "pdm0")}, {_seed_col("mdm", 0, "mdm0")},
        {_seed_col("close", 0, "x0")} FROM t),
e AS (SELECT *, {ewm_expr("tr", 1 / 14, 0, "tr0")} AS atr_w, {ewm_expr("pdm", 1 / 14, 0, "pdm0")} AS spdm,
        {ewm_expr("mdm", 1 / 14, 0, "mdm0")} AS smdm,
        {ewm_expr("close", 2 / 21, 0, "x0")} / {ewm_expr("close", 2 / 51, 0, "x0")} AS ema_ratio FROM s),
d AS (SELECT *, CASE WHEN atr_w <> 0 THEN 100.0 * spdm / atr_w END AS pdi, CASE WHEN atr_w <> 0 THEN 100.0 * smdm / atr_w END AS mdi FROM e),
x AS (SELECT *, CASE WHEN pdi + mdi <> 0 THEN 100.0 * abs(pdi - mdi) / (pdi + mdi) END AS dx FROM d),
y AS (SELECT *, min(CASE WHEN dx IS NOT NULL THEN bar_idx END) OVER (PARTITION BY {KS}) AS sdx FROM x),
z AS (SELECT *, max(CASE WHEN bar_idx = sdx THEN dx END) OVER (PARTITION BY {KS}) AS dxs FROM y)
SELECT {KS}, open_time, {r("ema_ratio")} AS ema_ratio, {sqlsrc.rnd(ewm_col("dx", 1 / 14, "sdx", "dxs"), 4)} AS adx_14 FROM z"""


SQL["i17_daily_context"] = (f"WITH bars AS (SELECT * FROM ({sqlsrc.bars_all()}) WHERE interval = '1d'), "
                            f"b AS (SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY open_time) - 1 AS bar_idx FROM bars)"
                            + f""",
m AS (SELECT *, lag(close) OVER w AS pc, high - lag(high) OVER w AS upm, lag(low) OVER w - low AS dnm FROM b {WIN}),
t AS (SELECT *, CASE WHEN pc IS NULL THEN high - low ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr,
        CASE WHEN upm > dnm AND upm > 0 THEN upm ELSE 0.0 END AS pdm,
        CASE WHEN dnm > upm AND dnm > 0 THEN dnm ELSE 0.0 END AS mdm,
        CASE WHEN pc IS NOT NULL THEN greatest(close - pc, 0) END AS up, CASE WHEN pc IS NOT NULL THEN greatest(pc - close, 0) END AS dn,
        CASE WHEN pc <> 0 THEN ln(close / pc) END AS ret FROM m),
s AS (SELECT *, {_seed_col("tr", 0, "tr0")}, {_seed_col("pdm", 0, "pdm0")}, {_seed_col("mdm", 0, "mdm0")},
        {_seed_col("close", 0, "x0")} FROM t),
e AS (SELECT *, {ewm_expr("tr", 1 / 14, 0, "tr0")} AS atr_w, {ewm_expr("pdm", 1 / 14, 0, "pdm0")} AS spdm,
        {ewm_expr("mdm", 1 / 14, 0, "mdm0")} AS smdm,
        {ewm_expr("close", 2 / 13, 0, "x0")} - {ewm_expr("close", 2 / 27, 0, "x0")} AS macd_line,
        {strict_sql("avg", "close", 20)} AS sma_20d, {strict_sql("avg", "close", 50)} AS sma_50d,
        {strict_sql("stddev_samp", "ret", 20)} AS ret_vol_20d,
        {strict_sql("avg", "up", 14)} AS ru, {strict_sql("avg", "dn", 14)} AS rd FROM s {WIN}),
d AS (SELECT *, CASE WHEN atr_w <> 0 THEN 100.0 * spdm / atr_w END AS pdi, CASE WHEN atr_w <> 0 THEN 100.0 * smdm / atr_w END AS mdi,
        {_seed_col("macd_line", 0, "m0")} FROM e),
x AS (SELECT *, CASE WHEN pdi + mdi <> 0 THEN 100.0 * abs(pdi - mdi) / (pdi + mdi) END AS dx,
        {ewm_expr("macd_line", 2 / 10, 0, "m0")} AS macd_signal FROM d),
y AS (SELECT *, min(CASE WHEN dx IS NOT NULL THEN bar_idx END) OVER (PARTITION BY {KS}) AS sdx FROM x),
z AS (SELECT *, max(CASE WHEN bar_idx = sdx THEN dx END) OVER (PARTITION BY {KS}) AS dxs FROM y)
SELECT {KS}, open_time, coalesce(CAST(sma_20d > sma_50d AS INTEGER), 0) AS trend_up_1d,
  {r("sma_20d")} AS sma_20d, {r("sma_50d")} AS sma_50d, {r("ret_vol_20d")} AS ret_vol_20d,
  {r("CASE WHEN ru IS NULL OR rd IS NULL THEN NULL WHEN rd = 0 AND ru = 0 THEN NULL WHEN rd = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + ru / rd) END")} AS rsi_14_1d,
  {sqlsrc.rnd("macd_line - macd_signal", 4)} AS macd_hist_1d, {sqlsrc.rnd(ewm_col("dx", 1 / 14, "sdx", "dxs"), 4)} AS adx_14_1d
FROM z""")


def _g4_sql_body():
    ctx = SQL["i18_i19_swing_context"]
    head = ctx[:ctx.rindex("SELECT")].rstrip() + ","
    return head + f"""
zn AS (SELECT *, coalesce(close > ema_slow AND close < ema_fast AND up, FALSE) AS in_zone_long,
         coalesce(close < ema_slow AND close > ema_fast AND down, FALSE) AS in_zone_short,
         lag(high) OVER w AS prev_high, lag(low) OVER w AS prev_low, atr_value < atr_sma AS low_volatility FROM g {WIN}),
st AS (SELECT *, in_zone_long AND NOT coalesce(lag(in_zone_long) OVER w, FALSE) AS sl,
         in_zone_short AND NOT coalesce(lag(in_zone_short) OVER w, FALSE) AS ss FROM zn {WIN}),
rs AS (SELECT *, max(CASE WHEN sl THEN bar_idx END) OVER (w ROWS UNBOUNDED PRECEDING) AS run_l,
         max(CASE WHEN ss THEN bar_idx END) OVER (w ROWS UNBOUNDED PRECEDING) AS run_s FROM st {WIN}),
pb AS (SELECT *, CASE WHEN in_zone_long THEN min(low) OVER (PARTITION BY {KS}, in_zone_long, run_l ORDER BY bar_idx
                    ROWS UNBOUNDED PRECEDING) END AS pullback_low,
         CASE WHEN in_zone_short THEN max(high) OVER (PARTITION BY {KS}, in_zone_short, run_s ORDER BY bar_idx
                    ROWS UNBOUNDED PRECEDING) END AS pullback_high FROM rs),
fs AS (SELECT *, coalesce(up AND pullback_low IS NOT NULL AND atr_decreasing AND close > prev_high AND close > open
                   AND NOT coalesce(low_volatility, FALSE), FALSE) AS long_setup,
         coalesce(down AND pullback_high IS NOT NULL AND atr_decreasing AND close < prev_low AND close < open
                   AND NOT coalesce(low_volatility, FALSE), FALSE) AS short_setup FROM pb)"""


SQL["g4_swing_setups"] = _g4_sql_body() + f"""
SELECT {KS}, open_time, in_zone_long, in_zone_short, long_setup, short_setup,
  {r("pullback_low")} AS pullback_low, {r("pullback_high")} AS pullback_high FROM fs"""

SQL["g5_regime_alerts"] = _g4_sql_body() + f""",
al AS (SELECT *, coalesce(up AND up <> lag(up) OVER w, FALSE) AS au, coalesce(down AND down <> lag(down) OVER w, FALSE) AS ad
       FROM fs {WIN})
SELECT {KS}, open_time, 'trending_up' AS alert FROM al WHERE au
UNION ALL SELECT {KS}, open_time, 'trending_down' FROM al WHERE ad
UNION ALL SELECT {KS}, open_time, 'long_entry' FROM al WHERE long_setup
UNION ALL SELECT {KS}, open_time, 'short_entry' FROM al WHERE short_setup"""
