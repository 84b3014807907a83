"""Registered queries: joins (J*), outcomes, labels and backtests (B*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import sqlsrc
from tidemark.catalog.common import bars_1h, bars_all, bars_every, prep, shared
from tidemark.functions import clean as C
from tidemark.operators import indicators as I
from tidemark.operators import joins as J
from tidemark.operators import outcomes as B
from tidemark.operators import series
from tidemark.operators import signals as G
from tidemark.sources import adapters as A

QUERIES, SQL = {}, {}
K = ["exchange", "symbol", "interval"]
KS = "exchange, symbol, interval"
rs = sqlsrc.rnd


def rnd(df, cols, n=6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) for c in cols})


def bars_plan(spark, sf):
    return bars_every(spark, sf, "15m").unionByName(bars_1h(spark, sf))


SQL_BARS_1H = sqlsrc.bars_events("1h")
SQL_BARS_PLAN = f"({sqlsrc.bars_events('15m')}) UNION ALL ({sqlsrc.bars_events('1h')})"

# ------------------------------------------------------------------ joins


def j1_universe_join(spark, sf):
    """Bars restricted to a universe (keys with >= 700 daily/hourly bars)."""
    b = bars_all(spark, sf)
    u = b.groupBy(*K).count().where(F.col("count") >= 700)
    return J.join_universe(b, u, K).select(*K, "open_time", "close")


SQL["j1_universe_join"] = f"""WITH b AS ({sqlsrc.bars_all()}),
u AS (SELECT {KS} FROM b GROUP BY ALL HAVING count(*) >= 700)
SELECT {KS}, open_time, close FROM b SEMI JOIN u USING ({KS})"""


def j3_asof_backward(spark, sf):
    """Each 4h bar gets the latest *completed* 1d bar of its symbol (available
    at close_time + 1) at or before its open, within 2 days; unmatched 4h
    bars are kept with NULLs (true left as-of join)."""
    prep(spark)
    b4 = A.bars_events(spark, sf, "4h").select("exchange", "symbol", F.col("open_time").alias("t"), "close")
    d1 = A.bars_events(spark, sf, "1d").select("exchange", "symbol", (F.col("close_time") + 1).alias("t"),
                                               F.col("close").alias("close_1d"), F.col("volume").alias("volume_1d"))
    out = J.asof_backward(b4, d1, on="t", by=["exchange", "symbol"], right_cols=["close_1d", "volume_1d"],
                          tolerance=2 * 86_400_000, prefix="d_")
    return out.select("exchange", "symbol", "t", "close", F.col("d_close_1d").alias("close_1d"),
                      F.col("d_volume_1d").alias("volume_1d"))


SQL["j3_asof_backward"] = f"""WITH l AS (SELECT exchange, symbol, open_time AS t, close FROM ({sqlsrc.bars_events('4h')})),
r AS (SELECT exchange, symbol, close_time + 1 AS t, close AS close_1d, volume AS volume_1d FROM ({sqlsrc.bars_events('1d')}))
SELECT l.exchange, l.symbol, l.t, l.close,
  CASE WHEN l.t - r.t <= 172800000 THEN r.close_1d END AS close_1d,
  CASE WHEN l.t - r.t <= 172800000 THEN r.volume_1d END AS volume_1d
FROM l ASOF LEFT JOIN r ON l.exchange = r.exchange AND l.symbol = r.symbol AND l.t >= r.t"""


def j4_asof_forward(spark, sf):
    """Each alert -> first 1h bar with open_time >= ts, with that bar's open."""
    prep(spark)
    a = A.alerts(spark, sf).select("id", "exchange", "symbol", "ts")
    b = bars_1h(spark, sf).select("exchange", "symbol", "open_time", "open")
    return J.asof_forward(a, b.withColumnRenamed("open_time", "ts"),
                          on="ts", by=["exchange", "symbol"], right_cols=["open"], prefix="e_") \
        .select("id", "exchange", "symbol", "ts", F.col("e_ts").alias("entry_open_time"), F.col("e_open").alias("entry_open"))


SQL["j4_asof_forward"] = f"""WITH a AS ({sqlsrc.alerts()}), b AS ({SQL_BARS_1H})
SELECT a.id, a.exchange, a.symbol, a.ts, b.open_time AS entry_open_time, b.open AS entry_open
FROM a ASOF LEFT JOIN b ON a.exchange = b.exchange AND a.symbol = b.symbol AND a.ts <= b.open_time"""


def j5_within_window(spark, sf):
    """Alerts paired with every 1h bar opening in [ts, ts + 6h] (bucketed join)."""
    prep(spark)
    a = A.alerts(spark, sf).select("id", "exchange", "symbol", "ts").withColumn("hi", F.col("ts") + 6 * 3_600_000)
    b = bars_1h(spark, sf).select("exchange", "symbol", "open_time", "high")
    p = J.within_time_window(a, b, ["exchange", "symbol"], "ts", "hi", "open_time", 6 * 3_600_000)
    return p.groupBy("id").agg(F.count(F.lit(1)).alias("n_bars"), F.max("high").alias("max_high"))


SQL["j5_within_window"] = f"""WITH a AS ({sqlsrc.alerts()}), b AS ({SQL_BARS_1H})
SELECT a.id, count(*) AS n_bars, max(b.high) AS max_high FROM a JOIN b
  ON a.exchange = b.exchange AND a.symbol = b.symbol AND b.open_time BETWEEN a.ts AND a.ts + 21600000
GROUP BY a.id"""


def j6_at_horizon(spark, sf):
    d = J.at_horizons(series.index_series(bars_all(spark, sf)), "close", [1, 4, 12], "close_h")
    return d.select(*K, "open_time", "close_h1", "close_h4", "close_h12")


SQL["j6_at_horizon"] = f"""WITH b AS ({sqlsrc.bars_all()})
SELECT {KS}, open_time, lead(close, 1) OVER w AS close_h1, lead(close, 4) OVER w AS close_h4,
  lead(close, 12) OVER w AS close_h12 FROM b WINDOW w AS (PARTITION BY {KS} ORDER BY open_time)"""


def j7_nth_previous(spark, sf):
    """For each bar, the 1st and 2nd most recent up-close bars strictly before it."""
    d = series.index_series(bars_all(spark, sf)).withColumn("up", F.col("close") > F.col("open"))
    d = J.nth_previous(d, "up", ["close"], 1, K)
    d = J.nth_previous(d, "up", ["close"], 2, K)
    return d.select(*K, "open_time", "prev1_idx", "prev1_close", "prev2_idx", "prev2_close")


SQL["j7_nth_previous"] = f"""WITH b AS ({sqlsrc.bars_all()}),
i AS (SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY open_time) - 1 AS bar_idx FROM b),
u AS (SELECT {KS}, bar_idx AS fidx, close, row_number() OVER (PARTITION BY {KS} ORDER BY bar_idx) - 1 AS fno
      FROM i WHERE close > open),
c AS (SELECT i.*, (SELECT count(*) FROM u WHERE u.exchange = i.exchange AND u.symbol = i.symbol
                   AND u.interval = i.interval AND u.fidx < i.bar_idx) AS seen FROM i)
SELECT c.exchange, c.symbol, c.interval, c.open_time, u1.fidx AS prev1_idx, u1.close AS prev1_close,
       u2.fidx AS prev2_idx, u2.close AS prev2_close
FROM c LEFT JOIN u u1 ON u1.exchange = c.exchange AND u1.symbol = c.symbol AND u1.interval = c.interval AND u1.fno = c.seen - 1
       LEFT JOIN u u2 ON u2.exchange = c.exchange AND u2.symbol = c.symbol AND u2.interval = c.interval AND u2.fno = c.seen - 2"""


def j8_permutation(spark, sf):
    """Reproducible permutation of close: every row's new value."""
    d = bars_all(spark, sf).withColumn("rid", F.concat_ws("/", "exchange", "symbol", "interval", F.col("open_time").cast("string")))
    return J.hash_shuffle_column(d, "close", 42, "rid").select("rid", "close")


SQL["j8_permutation"] = f"""WITH b AS (SELECT concat_ws('/', exchange, symbol, interval, open_time::VARCHAR) AS rid, close FROM ({sqlsrc.bars_all()})),
s AS (SELECT *, ('0x' || substr(md5('42:' || rid), 1, 8))::BIGINT % 64 AS salt FROM b),
a AS (SELECT *, row_number() OVER (PARTITION BY salt ORDER BY rid) AS k,
        row_number() OVER (PARTITION BY salt ORDER BY md5('43:' || rid), rid) AS k2 FROM s)
SELECT x.rid, y.close FROM a x JOIN a y ON x.salt = y.salt AND x.k = y.k2"""


# ------------------------------------------------------- alert outcomes B11-B14

def b13_dedup_alerts(spark, sf):
    prep(spark)
    return B.dedup_alerts(A.alerts(spark, sf)).select("id", "exchange", "symbol", "signal", "source_tf", "ts",
                                                      "dedup_bucket")


SQL_DEDUP = f"""SELECT * FROM (SELECT *, CAST(floor(ts / 3600000) AS BIGINT) AS dedup_bucket,
  row_number() OVER (PARTITION BY exchange, symbol, signal, source_tf, CAST(floor(ts / 3600000) AS BIGINT)
                     ORDER BY ts, id) AS rn FROM ({sqlsrc.alerts()}) a) WHERE rn = 1"""
SQL["b13_dedup_alerts"] = f"SELECT id, exchange, symbol, signal, source_tf, ts, dedup_bucket FROM ({SQL_DEDUP})"

H = (1, 4, 12, 24, 48)
OUT_COLS = [f"ret_h{h}" for h in H] + ["mfe", "mae"]


def _alert_outcomes(spark, sf):
    prep(spark)
    return B.alert_outcomes(A.alerts(spark, sf), bars_1h(spark, sf), "1h", H, 48)


def b11_b12_alert_outcomes(spark, sf):
    return rnd(_alert_outcomes(spark, sf), OUT_COLS).drop("interval")


SQL_OUTCOMES = f"""WITH a AS ({SQL_DEDUP}), b AS ({SQL_BARS_1H}),
fb AS (SELECT *, row_number() OVER w - 1 AS bar_idx,
  {', '.join(f'lead(close, {h}) OVER w AS close_h{h}' for h in H)},
  max(high) OVER (w ROWS BETWEEN CURRENT ROW AND 48 FOLLOWING) AS max_high_w,
  min(low) OVER (w ROWS BETWEEN CURRENT ROW AND 48 FOLLOWING) AS min_low_w
  FROM b WINDOW w AS (PARTITION BY exchange, symbol ORDER BY open_time)),
m AS (SELECT a.*, fb.open_time AS entry_open_time, fb.open AS entry_open, fb.bar_idx AS entry_bar_idx,
        {', '.join(f'fb.close_h{h}' for h in H)}, fb.max_high_w, fb.min_low_w
      FROM a ASOF JOIN fb ON a.exchange = fb.exchange AND a.symbol = fb.symbol AND a.ts <= fb.open_time)
SELECT exchange, symbol, signal, source_tf, ts, id, entry_open_time, entry_open, entry_bar_idx,
  CAST(hour(timezone('Australia/Sydney', make_timestamp(ts * 1000) AT TIME ZONE 'UTC')) AS INTEGER) AS hour_syd,
  strftime(timezone('Australia/Sydney', make_timestamp(ts * 1000) AT TIME ZONE 'UTC'), '%a') AS dow_syd,
  {', '.join(f'close_h{h} / entry_open - 1.0 AS ret_h{h}' for h in H)},
  max_high_w / entry_open - 1.0 AS mfe, min_low_w / entry_open - 1.0 AS mae
FROM m"""
SQL["b11_b12_alert_outcomes"] = (f"SELECT exchange, symbol, signal, source_tf, ts, id, entry_open_time, entry_open, "
                                 f"entry_bar_idx, hour_syd, dow_syd, "
                                 + ", ".join(f"{rs(c)} AS {c}" for c in OUT_COLS) + f" FROM ({SQL_OUTCOMES})")

SUM_COLS = ["hit_rate_pos", "avg_ret", "median_ret", "p10_ret", "p90_ret", "avg_mfe", "avg_mae"]


def b14_outcome_summary(spark, sf):
    return rnd(B.outcome_summary(_alert_outcomes(spark, sf), 24), SUM_COLS)


def _summary_sql(by, having=None):
    r = "ret_h24"
    hv = f" HAVING count(*) >= {having}" if having else ""
    return (f"SELECT {by}, count(*) AS n, count({r}) AS n_valid, "
            f"{rs(f'avg(CASE WHEN {r} > 0 THEN 1.0 ELSE 0.0 END)')} AS hit_rate_pos, {rs(f'avg({r})')} AS avg_ret, "
            f"{rs(f'quantile_cont({r}, 0.5)')} AS median_ret, {rs(f'quantile_cont({r}, 0.1)')} AS p10_ret, "
            f"{rs(f'quantile_cont({r}, 0.9)')} AS p90_ret, {rs('avg(mfe)')} AS avg_mfe, {rs('avg(mae)')} AS avg_mae "
            f"FROM ({SQL_OUTCOMES}) GROUP BY {by}{hv}")


SQL["b14_outcome_summary"] = _summary_sql("signal, source_tf")

SESSION_MIN_N = 10  # the notebook uses 50 at production volume; 10 keeps groups at test scale


def b14_session_summary(spark, sf):
    s = B.outcome_summary(_alert_outcomes(spark, sf), 24, ("signal", "source_tf", "dow_syd", "hour_syd"),
                          min_n=SESSION_MIN_N)
    return rnd(s, SUM_COLS)


SQL["b14_session_summary"] = _summary_sql("signal, source_tf, dow_syd, hour_syd", SESSION_MIN_N)


# -------------------------------------------------------------- plan backtest

def _plans(spark, sf):
    prep(spark)
    plans = C.silver_plans(A.trade_plans(spark, sf))
    alerts = C.silver_alerts(A.alerts(spark, sf))
    return C.with_plan_timeframe(plans, alerts, "15m")


def _trades(spark, sf):
    return B.plan_trades(_plans(spark, sf), bars_plan(spark, sf), B.PlanConfig())


TRADE_COLS = ["r_multiple", "mae_r", "mfe_r"]


def e1_plan_trades(spark, sf):
    return rnd(_trades(spark, sf), TRADE_COLS)


def e1_other_rules(spark, sf):
    """The plan backtest with the target first within a bar and resolution from the bar after the fill."""
    cfg = B.PlanConfig(include_entry_candle=False, intrabar_priority="tp_first")
    return rnd(B.plan_trades(_plans(spark, sf), bars_plan(spark, sf), cfg), TRADE_COLS)


W30 = 30 * 86_400_000
def _trades_sql(tp_first=False, next_bar=False):
    since = ">" if next_bar else ">="
    event = "CASE WHEN ev_th THEN 'TP1' ELSE 'STOP' END" if tp_first else "CASE WHEN ev_sh THEN 'STOP' ELSE 'TP1' END"
    return f"""WITH b AS ({SQL_BARS_PLAN}),
al AS ({sqlsrc.alerts()}),
p AS (SELECT pl.id AS plan_id, pl.alert_id, pl.ts AS plan_ts, pl.exchange, pl.symbol, upper(pl.side) AS side,
             pl.entry_price, pl.stop_loss, pl.tp1, pl.tp2, pl.tp3, coalesce(al.source_tf, '15m') AS tf
      FROM ({sqlsrc.trade_plans()}) pl LEFT JOIN al ON al.id = pl.alert_id),
c AS (SELECT p.*, b.open_time, b.high, b.low FROM p JOIN b ON b.exchange = p.exchange AND b.symbol = p.symbol
        AND b.interval = p.tf AND b.open_time BETWEEN p.plan_ts AND p.plan_ts + {2 * W30}),
f AS (SELECT plan_id, min(open_time) FILTER (WHERE entry_price IS NOT NULL AND low <= entry_price
        AND high >= entry_price AND open_time <= plan_ts + {W30}) AS entry_open_ms FROM c GROUP BY plan_id),
r AS (SELECT c.*, f.entry_open_ms,
        coalesce(CASE WHEN side = 'BUY' THEN low <= stop_loss WHEN side = 'SELL' THEN high >= stop_loss END, FALSE) AS sh,
        coalesce(CASE WHEN side = 'BUY' THEN high >= tp1 WHEN side = 'SELL' THEN low <= tp1 END, FALSE) AS th
      FROM c JOIN f USING (plan_id)
      WHERE f.entry_open_ms IS NOT NULL AND open_time {since} f.entry_open_ms AND open_time <= f.entry_open_ms + {W30}),
e AS (SELECT plan_id, min(open_time) FILTER (WHERE sh OR th) AS ev_t FROM r GROUP BY plan_id),
g AS (SELECT r.plan_id, any_value(alert_id) AS alert_id, any_value(plan_ts) AS plan_ts, any_value(exchange) AS exchange,
        any_value(symbol) AS symbol, any_value(tf) AS tf, any_value(side) AS side, any_value(entry_price) AS entry_price,
        any_value(stop_loss) AS stop_loss, any_value(tp1) AS tp1, any_value(tp2) AS tp2, any_value(tp3) AS tp3,
        min(low) AS min_low, max(high) AS max_high, count(*) AS candles_observed,
        count(*) FILTER (WHERE open_time < e.ev_t) AS bars_to_resolve,
        bool_or(sh) FILTER (WHERE open_time = e.ev_t) AS ev_sh, bool_or(th) FILTER (WHERE open_time = e.ev_t) AS ev_th, any_value(e.ev_t) AS ev_t
      FROM r JOIN e USING (plan_id) WHERE e.ev_t IS NOT NULL GROUP BY r.plan_id),
o AS (SELECT *, {event} AS event, abs(entry_price - stop_loss) AS risk FROM g)
SELECT sha256(concat_ws('::', CAST(plan_id AS VARCHAR), 'v1_entry_price_tp1', '30')) AS id, plan_id, alert_id,
  30 AS window_days, 'v1_entry_price_tp1' AS strategy_version, make_timestamp(plan_ts * 1000) AS created_ts,
  exchange, symbol, tf AS source_tf, side, entry_price AS entry, stop_loss AS stop, tp1, tp2, tp3,
  TRUE AS resolved, event,
  CASE WHEN risk <> 0 THEN (CASE WHEN side = 'BUY' THEN (CASE WHEN event = 'STOP' THEN stop_loss ELSE tp1 END) - entry_price
       WHEN side = 'SELL' THEN entry_price - (CASE WHEN event = 'STOP' THEN stop_loss ELSE tp1 END) END) / risk END AS r_multiple,
  CASE WHEN risk <> 0 THEN (CASE WHEN side = 'BUY' THEN entry_price - min_low WHEN side = 'SELL' THEN max_high - entry_price END) / risk END AS mae_r,
  CASE WHEN risk <> 0 THEN (CASE WHEN side = 'BUY' THEN max_high - entry_price WHEN side = 'SELL' THEN entry_price - min_low END) / risk END AS mfe_r,
  CAST(bars_to_resolve AS DOUBLE) AS bars_to_resolve, candles_observed, make_timestamp(ev_t * 1000) AS resolved_ts
FROM o"""


SQL_TRADES = _trades_sql()
SQL["e1_plan_trades"] = ("SELECT * EXCLUDE (r_multiple, mae_r, mfe_r), "
                         + ", ".join(f"{rs(c)} AS {c}" for c in TRADE_COLS) + f" FROM ({SQL_TRADES})")

SQL["e1_other_rules"] = ("SELECT * EXCLUDE (r_multiple, mae_r, mfe_r), " + ", ".join(f"{rs(c)} AS {c}" for c in TRADE_COLS)
                         + f" FROM ({_trades_sql(tp_first=True, next_bar=True)})")

RES_COLS = ["win_rate", "avg_r", "avg_mae_r", "avg_mfe_r", "avg_bars_to_resolve"]


def e1_plan_results(spark, sf):
    return rnd(B.plan_results(_trades(spark, sf)), RES_COLS)


SQL["e1_plan_results"] = f"""SELECT sha256(concat_ws('::', exchange, symbol, source_tf, strategy_version,
    CAST(window_days AS VARCHAR))) AS id, exchange, symbol, source_tf, window_days, strategy_version,
  count(*) AS n_trades, count(r_multiple) AS n_valid,
  {rs('avg(CASE WHEN r_multiple > 0 THEN 1.0 ELSE 0.0 END)')} AS win_rate, {rs('avg(r_multiple)')} AS avg_r,
  {rs('avg(mae_r)')} AS avg_mae_r, {rs('avg(mfe_r)')} AS avg_mfe_r, {rs('avg(bars_to_resolve)')} AS avg_bars_to_resolve
FROM ({SQL_TRADES}) GROUP BY ALL"""


# ------------------------------------------------------------ barrier labels

def _labels(spark, sf):
    f = I.ml_window_features(bars_all(spark, sf))
    return B.barrier_labels(f, 3.0, 2.0, 24, "discard_both", "atr", run_id="r1")


def b8_b9_barrier_labels(spark, sf):
    d = _labels(spark, sf)
    return rnd(d.select(*K, "open_time", "entry_bar_idx", "entry_open", "tp_price", "sl_price", "tp_hit_idx",
                        "sl_hit_idx", "ambiguous_same_bar", "label", "label_timeout", "label_variant", "run_id"),
               ["tp_price", "sl_price"])


SQL["b8_b9_barrier_labels"] = f"""WITH b AS ({sqlsrc.bars_all()}),
i AS (SELECT *, row_number() OVER w - 1 AS bar_idx, lag(close) OVER w AS pc FROM b
      WINDOW w AS (PARTITION BY {KS} ORDER BY open_time)),
t AS (SELECT *, CASE WHEN pc IS NULL THEN high - low ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr FROM i),
a AS (SELECT *, avg(tr) OVER (PARTITION BY {KS} ORDER BY bar_idx ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS atr FROM t),
e AS (SELECT *, lead(open) OVER w AS entry_open, lead(atr) OVER w AS atr_entry, bar_idx + 1 AS entry_bar_idx
      FROM a WINDOW w AS (PARTITION BY {KS} ORDER BY bar_idx)),
e2 AS (SELECT *, entry_open + 3.0 * atr_entry AS tp_price, entry_open - 2.0 * atr_entry AS sl_price FROM e
       WHERE entry_open IS NOT NULL AND atr_entry IS NOT NULL),
h AS (SELECT e2.exchange, e2.symbol, e2.interval, e2.bar_idx, min(CASE WHEN f.high >= e2.tp_price THEN f.bar_idx END) AS tp_hit_idx,
        min(CASE WHEN f.low <= e2.sl_price THEN f.bar_idx END) AS sl_hit_idx
      FROM e2 JOIN a f ON f.exchange = e2.exchange AND f.symbol = e2.symbol AND f.interval = e2.interval
        AND f.bar_idx BETWEEN e2.entry_bar_idx AND e2.entry_bar_idx + 24
      GROUP BY ALL),
l AS (SELECT e2.*, h.tp_hit_idx, h.sl_hit_idx,
        (h.tp_hit_idx IS NOT NULL AND h.sl_hit_idx IS NOT NULL AND h.tp_hit_idx = h.sl_hit_idx) AS amb FROM e2 JOIN h USING ({KS}, bar_idx)),
m AS (SELECT *, CASE WHEN amb THEN NULL
        WHEN tp_hit_idx IS NOT NULL AND (sl_hit_idx IS NULL OR tp_hit_idx < sl_hit_idx) THEN 1
        WHEN sl_hit_idx IS NOT NULL AND (tp_hit_idx IS NULL OR sl_hit_idx < tp_hit_idx) THEN 0 END AS label FROM l)
SELECT {KS}, open_time, entry_bar_idx, entry_open, {rs('tp_price')} AS tp_price, {rs('sl_price')} AS sl_price,
  tp_hit_idx, sl_hit_idx, CAST(amb AS INTEGER) AS ambiguous_same_bar, CAST(label AS INTEGER) AS label,
  CAST(label IS NULL AS INTEGER) AS label_timeout, 'TP3.0_SL2.0_W24_discard_both' AS label_variant, 'r1' AS run_id
FROM m"""


def b8_other_policies(spark, sf):
    """Labels where a bar that touches both barriers counts as a win, or as a loss; narrow barriers, so that there are some."""
    from functools import reduce
    d = I.ml_window_features(bars_all(spark, sf))
    out = [B.barrier_labels(d, tp_atr=0.5, sl_atr=0.5, w_bars=6, policy=p, run_id="r1") for p in ("tp_first", "sl_first")]
    return reduce(lambda a, b: a.unionByName(b), [x.select(*K, "open_time", "tp_hit_idx", "sl_hit_idx", "ambiguous_same_bar", "label", "label_variant") for x in out])


def _policies_sql():
    head = SQL["b8_b9_barrier_labels"]
    head = head[:head.index("m AS (SELECT *, CASE WHEN amb")].rstrip().rstrip(",")
    head = head.replace("entry_open + 3.0 * atr_entry", "entry_open + 0.5 * atr_entry").replace(
        "entry_open - 2.0 * atr_entry", "entry_open - 0.5 * atr_entry").replace("e2.entry_bar_idx + 24", "e2.entry_bar_idx + 6")
    part = """SELECT {ks}, open_time, tp_hit_idx, sl_hit_idx, CAST(amb AS INTEGER) AS ambiguous_same_bar,
  CAST(CASE WHEN amb THEN {won} WHEN tp_hit_idx IS NOT NULL AND (sl_hit_idx IS NULL OR tp_hit_idx < sl_hit_idx) THEN 1
       WHEN sl_hit_idx IS NOT NULL THEN 0 END AS INTEGER) AS label, 'TP0.5_SL0.5_W6_{p}' AS label_variant FROM l"""
    return head + " " + " UNION ALL ".join(part.format(ks=KS, won=w, p=p) for w, p in ((1, "tp_first"), (0, "sl_first")))


SQL["b8_other_policies"] = _policies_sql()


# ------------------------------------------------------ grid backtest (R)

def _grid(spark, sf):
    return shared(spark, sf, "grid_trades", lambda: B.signal_backtest(
        G.momentum_signals(bars_all(spark, sf)), "sig_breakout_long", run_id="r1"))


def b7_b10_signal_backtest(spark, sf):
    return rnd(_grid(spark, sf), ["entry", "stop", "tp", "exit", "r_multiple", "atrp_entry"])


SUMMARY_COLS = ["win_rate", "avg_r", "avg_bars_held", "median_r", "p10_r", "p90_r"]


def b15_grid_results(spark, sf):
    return rnd(B.grid_results(_grid(spark, sf)), SUMMARY_COLS)


def b16_trade_summary(spark, sf):
    return rnd(B.trade_summary(_grid(spark, sf), ["signal", "max_hold_bars"]), SUMMARY_COLS)


def b21_risk_sizing(spark, sf):
    prep(spark)
    p = A.trade_plans(spark, sf)
    return rnd(p.select("id", B.risk_size(10_000.0, 1.0, "entry_price", "stop_loss").alias("units")), ["units"])


SQL["b21_risk_sizing"] = f"""SELECT id, {rs('CASE WHEN abs(entry_price - stop_loss) > 0 THEN 10000.0 * 1.0 / 100.0 / abs(entry_price - stop_loss) ELSE 0.0 END')} AS units
FROM ({sqlsrc.trade_plans()})"""


def b22_non_overlapping(spark, sf):
    t = _grid(spark, sf).withColumn("entry_ms", F.unix_millis("entry_time_utc")).withColumn(
        "exit_ms", F.unix_millis("exit_time_utc"))
    k = B.non_overlapping(t, ["exchange", "symbol", "interval", "atr_mult_stop", "atr_mult_tp", "max_hold_bars"],
                          "entry_ms", "exit_ms", ["entry_ms", "exit_ms"])
    return k.select("exchange", "symbol", "interval", "atr_mult_stop", "max_hold_bars", "entry_ms", "exit_ms")


PERF_COLS = ["net_r", "win_rate", "profit_factor", "avg_r", "avg_win_r", "avg_loss_r", "max_drawdown_r",
             "expectancy_r"]


def b23_performance(spark, sf):
    t = _grid(spark, sf).withColumn("exit_ms", F.unix_millis("exit_time_utc"))
    return rnd(B.performance_summary(t, ["exchange", "symbol", "interval", "max_hold_bars", "atr_mult_stop"]),
               PERF_COLS)


PERF_KEYS = ["exchange", "symbol", "interval", "max_hold_bars", "atr_mult_stop"]


def _monthly(spark, sf):
    return B.monthly_results(_grid(spark, sf).withColumn("exit_ms", F.unix_millis("exit_time_utc")), PERF_KEYS)


def b23_monthly(spark, sf):
    return rnd(_monthly(spark, sf), ["net_r"])


def b23_sharpe(spark, sf):
    return rnd(B.sharpe(_monthly(spark, sf), PERF_KEYS), ["mean_month_r", "worst_month_r", "sharpe"])


for _n, _f in list(globals().items()):
    if callable(_f) and (_n[:1] in ("j", "b") and _n[1:2].isdigit() or _n.startswith("e1_")):
        QUERIES[_n] = _f


def _b7_sql():
    from tidemark.catalog.q_indicators import SQL as ISQL
    sig = ISQL["g1_g3_momentum_signals"]
    # reuse the signal statement's CTEs: replace its final SELECT with the backtest
    head = sig[:sig.rindex("SELECT")].rstrip() + ","
    ms = "exchange, symbol, interval"
    return head + f"""
g AS (SELECT * FROM (VALUES (1.5, 2.5, 48), (2.0, 3.0, 48), (2.5, 3.5, 72)) v(atr_mult_stop, atr_mult_tp, max_hold_bars)),
nb AS (SELECT {ms}, max(bar_idx) AS last_idx FROM f GROUP BY ALL),
sg AS (SELECT f.{ms.replace(', ', ', f.')}, f.bar_idx, lead(open) OVER w AS e_open, lead(atr_14) OVER w AS e_atr,
         lead(atrp_14) OVER w AS e_atrp, lead(open_time) OVER w AS e_t, lead(open_time, 2) OVER w AS t2,
         coalesce(trend_up AND brk, FALSE) AS sig FROM f WINDOW w AS (PARTITION BY {ms} ORDER BY bar_idx)),
en AS (SELECT sg.*, g.*, nb.last_idx, e_open - atr_mult_stop * e_atr AS stop, e_open + atr_mult_tp * e_atr AS tp,
         least(nb.last_idx, bar_idx + 1 + max_hold_bars) AS lst
       FROM sg JOIN nb USING ({ms}) CROSS JOIN g
       WHERE sig AND t2 IS NOT NULL AND e_open IS NOT NULL AND e_atr IS NOT NULL AND e_atr > 0),
hit AS (SELECT en.{ms.replace(', ', ', en.')}, en.bar_idx, en.atr_mult_stop, en.max_hold_bars,
          min(CASE WHEN f.low <= en.stop OR f.high >= en.tp THEN f.bar_idx END) AS hit_idx
        FROM en JOIN f ON f.exchange = en.exchange AND f.symbol = en.symbol AND f.interval = en.interval
          AND f.bar_idx BETWEEN en.bar_idx + 1 AND en.lst
        GROUP BY ALL),
x AS (SELECT en.*, hit.hit_idx, coalesce(hit.hit_idx, en.lst) AS exit_idx FROM en JOIN hit USING ({ms}, bar_idx, atr_mult_stop, max_hold_bars)),
y AS (SELECT x.*, fb.low AS xl, fb.close AS xc, fb.open_time AS xt,
        CASE WHEN x.hit_idx IS NULL THEN 'time' WHEN fb.low <= x.stop THEN 'stop' ELSE 'tp' END AS outcome
      FROM x JOIN f fb ON fb.exchange = x.exchange AND fb.symbol = x.symbol AND fb.interval = x.interval AND fb.bar_idx = x.exit_idx),
ed AS (SELECT {ms}, quantile_cont(atrp_14, [0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM f GROUP BY ALL),
z AS (SELECT y.*, CASE WHEN outcome = 'stop' THEN stop WHEN outcome = 'tp' THEN tp ELSE xc END AS exit_px,
        CASE WHEN len(list_distinct(ed.e)) = len(ed.e) THEN
          CASE WHEN e_atrp >= ed.e[1] AND e_atrp <= ed.e[2] THEN 'Q1_low' WHEN e_atrp > ed.e[2] AND e_atrp <= ed.e[3] THEN 'Q2'
               WHEN e_atrp > ed.e[3] AND e_atrp <= ed.e[4] THEN 'Q3' WHEN e_atrp > ed.e[4] AND e_atrp <= ed.e[5] THEN 'Q4'
               WHEN e_atrp > ed.e[5] AND e_atrp <= ed.e[6] THEN 'Q5_high' END END AS atrp_bucket
      FROM y LEFT JOIN ed USING ({ms}))
SELECT 'r1' AS run_id, {ms}, 'sig_breakout_long' AS signal, atr_mult_stop, atr_mult_tp, CAST(max_hold_bars AS INTEGER) AS max_hold_bars,
  {rs('e_atrp')} AS atrp_entry, atrp_bucket, make_timestamp(e_t * 1000) AS entry_time_utc,
  timezone('Australia/Sydney', make_timestamp(e_t * 1000) AT TIME ZONE 'UTC') AS entry_time_syd,
  make_timestamp(xt * 1000) AS exit_time_utc, {rs('e_open')} AS entry, {rs('stop')} AS stop, {rs('tp')} AS tp,
  {rs('exit_px')} AS exit, CAST(exit_idx - bar_idx - 1 AS INTEGER) AS bars_held, outcome,
  {rs('CASE WHEN e_open - stop <> 0 THEN (exit_px - e_open) / (e_open - stop) END')} AS r_multiple
FROM z"""


SQL["b7_b10_signal_backtest"] = _b7_sql()


def _summary_over_trades(by):
    r = "r_multiple"
    return (f"SELECT {by}, count(*) AS n_trades, {rs(f'avg(CASE WHEN {r} > 0 THEN 1.0 ELSE 0.0 END)')} AS win_rate, "
            f"{rs(f'avg({r})')} AS avg_r, {rs('avg(bars_held)')} AS avg_bars_held, "
            f"{rs(f'quantile_cont({r}, 0.5)')} AS median_r, {rs(f'quantile_cont({r}, 0.1)')} AS p10_r, "
            f"{rs(f'quantile_cont({r}, 0.9)')} AS p90_r FROM ({_b7_raw_sql()}) GROUP BY {by}")


def _b7_raw_sql():
    # the backtest statement with unrounded R for the summaries
    return SQL["b7_b10_signal_backtest"].replace(
        rs('CASE WHEN e_open - stop <> 0 THEN (exit_px - e_open) / (e_open - stop) END') + " AS r_multiple",
        "CASE WHEN e_open - stop <> 0 THEN (exit_px - e_open) / (e_open - stop) END AS r_multiple")


SQL["b15_grid_results"] = _summary_over_trades(
    "run_id, exchange, symbol, interval, signal, atr_mult_stop, atr_mult_tp, max_hold_bars, atrp_bucket")
SQL["b16_trade_summary"] = _summary_over_trades("signal, max_hold_bars")


SQL["b22_non_overlapping"] = f"""WITH RECURSIVE t AS (
  SELECT exchange, symbol, interval, atr_mult_stop, atr_mult_tp, max_hold_bars,
         epoch_ms(entry_time_utc) AS entry_ms, epoch_ms(exit_time_utc) AS exit_ms FROM ({_b7_raw_sql()})),
c(exchange, symbol, interval, atr_mult_stop, atr_mult_tp, max_hold_bars, entry_ms, exit_ms) AS (
  SELECT exchange, symbol, interval, atr_mult_stop, atr_mult_tp, max_hold_bars, entry_ms, exit_ms FROM (
    SELECT *, row_number() OVER (PARTITION BY exchange, symbol, interval, atr_mult_stop, atr_mult_tp, max_hold_bars
                                 ORDER BY entry_ms, exit_ms) AS rn FROM t) WHERE rn = 1
  UNION ALL
  SELECT c.exchange, c.symbol, c.interval, c.atr_mult_stop, c.atr_mult_tp, c.max_hold_bars, n.entry_ms, n.exit_ms
  FROM c, LATERAL (SELECT x.entry_ms, x.exit_ms FROM t x WHERE x.exchange = c.exchange AND x.symbol = c.symbol
      AND x.interval = c.interval AND x.atr_mult_stop = c.atr_mult_stop AND x.atr_mult_tp = c.atr_mult_tp
      AND x.max_hold_bars = c.max_hold_bars AND x.entry_ms > c.exit_ms ORDER BY x.entry_ms, x.exit_ms LIMIT 1) n)
SELECT exchange, symbol, interval, atr_mult_stop, max_hold_bars, entry_ms, exit_ms FROM c"""


def perf_sql(by: str, extra: str = "") -> str:
    """SQL performance summary over the grid trades."""
    pb = f"PARTITION BY {by}"
    r = "r_multiple"
    return f"""WITH t AS (SELECT *, epoch_ms(exit_time_utc) AS exit_ms{extra} FROM ({_b7_raw_sql()})),
o AS (SELECT *, row_number() OVER ({pb} ORDER BY exit_ms, {r}) AS k FROM t),
e AS (SELECT *, sum(coalesce({r}, 0)) OVER ({pb} ORDER BY k ROWS UNBOUNDED PRECEDING) AS eq FROM o),
p AS (SELECT *, greatest(0, max(eq) OVER ({pb} ORDER BY k ROWS UNBOUNDED PRECEDING)) AS peak, {r} > 0 AS win FROM e),
c AS (SELECT *, coalesce(win <> lag(win) OVER ({pb} ORDER BY k), TRUE) AS chg FROM p),
rn AS (SELECT *, sum(CAST(chg AS INTEGER)) OVER ({pb} ORDER BY k ROWS UNBOUNDED PRECEDING) AS run FROM c),
runs AS (SELECT {by}, run, any_value(win) AS w, count(*) AS len FROM rn GROUP BY ALL),
st AS (SELECT {by}, max(len) FILTER (WHERE w) AS max_win_streak, max(len) FILTER (WHERE NOT w) AS max_loss_streak
       FROM runs GROUP BY ALL),
g AS (SELECT {by}, count(*) AS n_trades, sum({r}) AS net_r, avg(CASE WHEN {r} > 0 THEN 1.0 ELSE 0.0 END) AS win_rate,
        CASE WHEN -sum({r}) FILTER (WHERE {r} < 0) <> 0
             THEN sum({r}) FILTER (WHERE {r} > 0) / -sum({r}) FILTER (WHERE {r} < 0) END AS profit_factor,
        avg({r}) AS avg_r, avg({r}) FILTER (WHERE {r} > 0) AS avg_win_r, avg({r}) FILTER (WHERE {r} <= 0) AS avg_loss_r,
        min(eq - peak) AS max_drawdown_r FROM rn GROUP BY ALL),
h AS (SELECT g.*, win_rate * coalesce(avg_win_r, 0) + (1 - win_rate) * coalesce(avg_loss_r, 0) AS expectancy_r,
        st.max_win_streak, st.max_loss_streak FROM g LEFT JOIN st USING ({by}))
SELECT {by}, n_trades, max_win_streak, max_loss_streak, {', '.join(f"{rs(c)} AS {c}" for c in PERF_COLS)} FROM h"""


SQL["b23_performance"] = perf_sql("exchange, symbol, interval, max_hold_bars, atr_mult_stop")

_MONTHLY = f"""SELECT {', '.join(PERF_KEYS)}, strftime(exit_time_utc, '%Y-%m') AS month, count(*) AS n_trades, sum(r_multiple) AS net_r
FROM ({_b7_raw_sql()}) GROUP BY ALL"""
SQL["b23_monthly"] = f"SELECT * REPLACE ({rs('net_r')} AS net_r) FROM ({_MONTHLY})"
SQL["b23_sharpe"] = f"""SELECT {', '.join(PERF_KEYS)}, count(*) AS months, {rs('avg(net_r)')} AS mean_month_r, {rs('min(net_r)')} AS worst_month_r,
  {rs('CASE WHEN stddev_samp(net_r) <> 0 THEN avg(net_r) / stddev_samp(net_r) * sqrt(12) END')} AS sharpe FROM ({_MONTHLY}) GROUP BY ALL"""
