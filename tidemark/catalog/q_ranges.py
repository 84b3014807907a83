"""Registered queries: swing points and locked ranges (L*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import sqlsrc
from tidemark.catalog.common import bars_all
from tidemark.operators import indicators as I
from tidemark.operators import ranges as L
from tidemark.operators import series
from tidemark.operators import windows as W

QUERIES, SQL = {}, {}
K = ["exchange", "symbol", "interval"]
KS = "exchange, symbol, interval"
rs = sqlsrc.rnd

RANGE_DBL = ["range_high", "range_low", "range_height", "avg_volume", "buy_pressure", "sell_pressure", "imbalance",
             "tpsl1_high", "tpsl1_low", "tpsl2_high", "tpsl2_low"]


def rnd(df, cols, n=6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) for c in cols})


def l1_l2_swing_points(spark, sf):
    d = L.swing_points(bars_all(spark, sf), 5)
    return d.where(F.col("swing_high") | F.col("swing_low")).select(*K, "open_time", "bar_idx", "swing_high",
                                                                     "swing_low", "pivot_confirmed_at")


BASE = f"""WITH RECURSIVE bars AS ({sqlsrc.bars_all()}),
i0 AS (SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY open_time) - 1 AS bar_idx,
         lag(close) OVER (PARTITION BY {KS} ORDER BY open_time) AS pc FROM bars),
i1 AS (SELECT *, CASE WHEN pc IS NULL THEN high - low ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr FROM i0),
i AS (SELECT *, CASE WHEN count(tr) OVER w14 >= 14 THEN avg(tr) OVER w14 END AS atr,
        coalesce(high - low < 0.5 * CASE WHEN count(tr) OVER w14 >= 14 THEN avg(tr) OVER w14 END, FALSE) AS is_narrow,
        count(high) OVER wb = 5 AND count(high) OVER wf = 5 AND high > max(high) OVER wb AND high > max(high) OVER wf AS swing_high,
        count(low) OVER wb = 5 AND count(low) OVER wf = 5 AND low < min(low) OVER wb AND low < min(low) OVER wf AS swing_low
      FROM i1 WINDOW w14 AS (PARTITION BY {KS} ORDER BY bar_idx ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
        wb AS (PARTITION BY {KS} ORDER BY bar_idx ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
        wf AS (PARTITION BY {KS} ORDER BY bar_idx ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING))"""

SQL["l1_l2_swing_points"] = BASE + f"""
SELECT {KS}, open_time, bar_idx, swing_high, swing_low, bar_idx + 5 AS pivot_confirmed_at FROM i
WHERE swing_high OR swing_low"""


def l3_narrow_bars(spark, sf):
    b = series.index_series(bars_all(spark, sf))
    a = L.narrow_bars(b, "atr_sma").select(*K, "bar_idx", "open_time", F.col("is_narrow").alias("narrow_atr_sma"))
    c = L.narrow_bars(b, "range_sma").select(*K, "bar_idx", F.col("is_narrow").alias("narrow_range_sma"))
    return a.join(c, [*K, "bar_idx"]).drop("bar_idx")


SQL["l3_narrow_bars"] = BASE + f"""
SELECT {KS}, open_time, is_narrow AS narrow_atr_sma,
  coalesce(high - low < 1.5 * CASE WHEN count(high) OVER w20 >= 20 THEN avg(high - low) OVER w20 END, FALSE) AS narrow_range_sma
FROM i WINDOW w20 AS (PARTITION BY {KS} ORDER BY bar_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""


def _fixed(spark, sf):
    return L.fixed_ranges(bars_all(spark, sf))


def l4_l18_fixed_ranges(spark, sf):
    r = _fixed(spark, sf)
    return rnd(r.select(*K, "start_time", "end_time", "start_idx", "end_idx", "duration_bars", "high_touches",
                        "low_touches", "type", *RANGE_DBL), RANGE_DBL)


RANGES_SQL = BASE + f""",
nar AS (SELECT {KS}, bar_idx FROM i WHERE is_narrow),
chain(exchange, symbol, interval, s) AS (
  SELECT {KS}, min(bar_idx) FROM nar GROUP BY ALL
  UNION ALL
  SELECT c.exchange, c.symbol, c.interval,
    (SELECT min(x.bar_idx) FROM nar x WHERE x.exchange = c.exchange AND x.symbol = c.symbol
       AND x.interval = c.interval AND x.bar_idx > c.s + 50)
  FROM chain c WHERE c.s IS NOT NULL),
n AS (SELECT {KS}, count(*) AS n, max(bar_idx) AS last FROM i GROUP BY ALL),
st AS (SELECT c.* FROM chain c JOIN n USING ({KS}) WHERE c.s IS NOT NULL AND n.n >= 20 AND c.s + 50 <= n.last),
rb AS (SELECT i.*, st.s,
         max(high) OVER (PARTITION BY i.exchange, i.symbol, i.interval, st.s ORDER BY bar_idx ROWS UNBOUNDED PRECEDING) AS top,
         min(low) OVER (PARTITION BY i.exchange, i.symbol, i.interval, st.s ORDER BY bar_idx ROWS UNBOUNDED PRECEDING) AS bot
       FROM i JOIN st ON i.exchange = st.exchange AND i.symbol = st.symbol AND i.interval = st.interval
         AND i.bar_idx BETWEEN st.s AND st.s + 50),
rt AS (SELECT *, bar_idx <> s AND high >= top - atr * 0.1 AS ht, bar_idx <> s AND low <= bot + atr * 0.1 AS lt FROM rb),
ag AS (SELECT {KS}, s AS start_idx, min(open_time) AS start_time, max(open_time) AS end_time, max(bar_idx) AS end_idx,
         max(high) AS range_high, min(low) AS range_low, count(*) AS duration_bars, avg(volume) AS avg_volume,
         count(*) FILTER (WHERE ht) AS high_touches, count(*) FILTER (WHERE lt) AS low_touches,
         coalesce(sum(volume) FILTER (WHERE ht), 0.0) AS hv, coalesce(sum(volume) FILTER (WHERE lt), 0.0) AS lv
       FROM rt GROUP BY ALL),
pr AS (SELECT *, range_high - range_low AS range_height, hv / greatest(high_touches, 1) AS buy_pressure,
         lv / greatest(low_touches, 1) AS sell_pressure FROM ag),
im AS (SELECT *, CASE WHEN buy_pressure = 0 AND sell_pressure = 0 THEN 0.0
         ELSE (buy_pressure - sell_pressure) / greatest(buy_pressure, sell_pressure) END AS imbalance FROM pr),
sw AS (SELECT pr.exchange, pr.symbol, pr.interval, pr.start_idx,
  (SELECT high FROM i x WHERE x.exchange = pr.exchange AND x.symbol = pr.symbol AND x.interval = pr.interval AND x.swing_high
     AND x.bar_idx < pr.start_idx AND x.bar_idx > greatest(0, pr.start_idx - 50) ORDER BY x.bar_idx DESC LIMIT 1) AS h1,
  (SELECT low FROM i x WHERE x.exchange = pr.exchange AND x.symbol = pr.symbol AND x.interval = pr.interval AND x.swing_low
     AND x.bar_idx < pr.start_idx AND x.bar_idx > greatest(0, pr.start_idx - 50) ORDER BY x.bar_idx DESC LIMIT 1) AS l1,
  (SELECT high FROM i x WHERE x.exchange = pr.exchange AND x.symbol = pr.symbol AND x.interval = pr.interval AND x.swing_high
     AND x.bar_idx < pr.start_idx AND x.bar_idx > greatest(0, pr.start_idx - 100) ORDER BY x.bar_idx DESC LIMIT 1 OFFSET 1) AS h2,
  (SELECT low FROM i x WHERE x.exchange = pr.exchange AND x.symbol = pr.symbol AND x.interval = pr.interval AND x.swing_low
     AND x.bar_idx < pr.start_idx AND x.bar_idx > greatest(0, pr.start_idx - 100) ORDER BY x.bar_idx DESC LIMIT 1 OFFSET 1) AS l2
  FROM pr),
fr AS (SELECT im.*, CASE WHEN imbalance > 0.15 THEN 'Resistance' WHEN imbalance < -0.15 THEN 'Support' ELSE 'Gravitation' END AS type,
         CASE WHEN sw.h1 IS NOT NULL AND sw.h1 <> 0 AND sw.h1 > range_high THEN sw.h1 ELSE range_high + range_height END AS tpsl1_high,
         CASE WHEN sw.l1 IS NOT NULL AND sw.l1 <> 0 AND sw.l1 < range_low THEN sw.l1 ELSE range_low - range_height END AS tpsl1_low,
         sw.h2 AS tpsl2_high, sw.l2 AS tpsl2_low
       FROM im JOIN sw USING ({KS}, start_idx))"""

SQL["l4_l18_fixed_ranges"] = RANGES_SQL + f"""
SELECT {KS}, start_time, end_time, start_idx, end_idx, duration_bars, high_touches, low_touches, type,
  {', '.join(f'{rs(c)} AS {c}' for c in RANGE_DBL)} FROM fr"""


RULES = [("auto", "beyond"), ("swing", "half"), ("height", "fixed"), ("swing", "second_swing")]


def l12_l13_target_rules(spark, sf):
    """Targets of every fixed range under other rules than the report's, heights counted 1.5 times."""
    r = L.fixed_ranges(bars_all(spark, sf), tpsl=RULES, height_mult=1.5)
    cols = ["tpsl1_high", "tpsl1_low", "tpsl2_high", "tpsl2_low"]
    return rnd(r.select(*K, "start_idx", "method1", "method2", *cols), cols)


def _rules_sql():
    side = {"high": ("range_high", "h", ">", "+"), "low": ("range_low", "l", "<", "-")}
    first = {"auto": "{s}1 IS NOT NULL AND {s}1 <> 0 AND {s}1 {o} {e}", "swing": "{s}1 IS NOT NULL", "height": "FALSE"}
    out = []
    for m1, m2 in RULES:
        cols = []
        for name, (e, s, o, g) in side.items():
            t1 = f"CASE WHEN {first[m1].format(s=s, o=o, e=e)} THEN {s}1 ELSE {e} {g} hh END"
            half = f"{t1} {g} hh / 2"
            t2 = {"beyond": f"CASE WHEN {s}2 IS NOT NULL AND {s}2 {o} {t1} THEN {s}2 ELSE {half} END", "half": half,
                  "fixed": f"{e} {g} 1.5 * hh", "second_swing": f"{s}2"}[m2]
            cols += [f"{rs(t1)} AS tpsl1_{name}", f"{rs(t2)} AS tpsl2_{name}"]
        out.append(f"SELECT {KS}, start_idx, '{m1}' AS method1, '{m2}' AS method2, {', '.join(cols)} FROM tg")
    return RANGES_SQL + f""",
tg AS (SELECT im.*, range_height * 1.5 AS hh, sw.h1, sw.l1, sw.h2, sw.l2 FROM im JOIN sw USING ({KS}, start_idx))
""" + " UNION ALL ".join(out)


SQL["l12_l13_target_rules"] = _rules_sql()


def l10_l11_range_labels(spark, sf):
    """Volume degree of each fixed range (total volume vs SMA20 volume at the
    range end x bars) and imbalance strength label."""
    b = I.volume_ratio(series.index_series(bars_all(spark, sf)), 20, "_vr")
    vs = series.halo_windows(b, lambda w: {"vol_sma20": W.sma("volume", w, 20)}, back=20)
    r = _fixed(spark, sf)
    r = r.join(vs.select(*K, F.col("bar_idx").alias("end_idx"), "vol_sma20"), [*K, "end_idx"], "left")
    r = r.withColumn("total_volume", F.col("avg_volume") * F.col("duration_bars"))
    return r.select(*K, "start_idx", L.volume_degree(F.col("total_volume"), F.col("vol_sma20"),
                                                     F.col("duration_bars")).alias("volume_degree"),
                    L.strength_label(F.col("imbalance") * 100).alias("strength"))


SQL["l10_l11_range_labels"] = RANGES_SQL + f""",
vs AS (SELECT {KS}, bar_idx, CASE WHEN count(volume) OVER w20 >= 20 THEN avg(volume) OVER w20 END AS vol_sma20 FROM i
       WINDOW w20 AS (PARTITION BY {KS} ORDER BY bar_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
x AS (SELECT fr.*, vs.vol_sma20, avg_volume * duration_bars AS total_volume FROM fr LEFT JOIN vs
       ON vs.exchange = fr.exchange AND vs.symbol = fr.symbol AND vs.interval = fr.interval AND vs.bar_idx = fr.end_idx)
SELECT {KS}, start_idx,
  CASE WHEN total_volume / NULLIF(vol_sma20 * duration_bars, 0) > 1.5 THEN 'High'
       WHEN total_volume / NULLIF(vol_sma20 * duration_bars, 0) > 0.8 THEN 'Medium' ELSE 'Low' END AS volume_degree,
  CASE WHEN abs(imbalance * 100) >= 25 THEN 'Strong' WHEN abs(imbalance * 100) >= 15 THEN 'Moderate' ELSE 'Weak' END AS strength
FROM x"""


def l17_latest_ranges(spark, sf):
    r = L.latest_ranges(_fixed(spark, sf), 5)
    return r.select(*K, "start_idx", "recency_rank")


SQL["l17_latest_ranges"] = RANGES_SQL + f"""
SELECT {KS}, start_idx, recency_rank FROM (SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY end_idx DESC) AS recency_rank FROM fr)
WHERE recency_rank <= 5"""


def l19_confluence(spark, sf):
    r = L.confluence(_fixed(spark, sf))
    return r.select(*K, "start_idx", "type", "prev_type", "stacking", "same_type_run")


SQL["l19_confluence"] = RANGES_SQL + f""",
c AS (SELECT *, lag(type) OVER w AS prev_type, row_number() OVER w - 1 AS ri FROM fr
      WINDOW w AS (PARTITION BY {KS} ORDER BY start_time)),
g AS (SELECT *, type = prev_type AS stacking,
        max(CASE WHEN NOT coalesce(type = prev_type, FALSE) THEN ri END) OVER (PARTITION BY {KS} ORDER BY ri ROWS UNBOUNDED PRECEDING) AS s FROM c)
SELECT {KS}, start_idx, type, prev_type, stacking, ri - s + 1 AS same_type_run FROM g"""


for _n, _f in list(globals().items()):
    if callable(_f) and _n[:1] == "l" and _n[1:2].isdigit():
        QUERIES[_n] = _f


def l9_simple_imbalance(spark, sf):
    d = L.simple_imbalance(bars_all(spark, sf))
    return rnd(d.where(F.col("simple_imbalance").isNotNull()).select(
        *K, "open_time", "run_start", "cons_bars", "cons_high", "cons_low", "vol_at_high", "vol_at_low",
        "simple_imbalance", "simple_type"), ["vol_at_high", "vol_at_low", "simple_imbalance"])


QUERIES["l9_simple_imbalance"] = l9_simple_imbalance


def _l9_sql():
    from tidemark.catalog.q_indicators import IDX_CTE, WIN, _seed_col, ewm_expr, rows, strict_sql
    return IDX_CTE + f""", t AS (SELECT *, CASE WHEN lag(close) OVER w IS NULL THEN high - low ELSE
  greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) END AS tr,
  abs(close - open) AS body FROM b {WIN}),
s AS (SELECT *, avg(tr) OVER {rows(14)} AS sma_tr, {strict_sql("avg", "body", 20)} AS bs FROM t {WIN}),
x AS (SELECT *, {_seed_col("sma_tr", 13, "x13")} FROM s),
a AS (SELECT *, {ewm_expr("tr", 1 / 14, 13, "x13")} AS atr FROM x),
n AS (SELECT *, coalesce(bs < 0.5 * atr, FALSE) AS is_narrow FROM a),
st AS (SELECT *, is_narrow AND NOT coalesce(lag(is_narrow) OVER w, FALSE) AS stt FROM n {WIN}),
rs AS (SELECT *, CASE WHEN is_narrow THEN max(CASE WHEN stt THEN bar_idx END) OVER (w ROWS UNBOUNDED PRECEDING) END AS run_start
       FROM st {WIN}),
ch AS (SELECT *, bar_idx - run_start + 1 AS cons_bars,
         CASE WHEN run_start IS NOT NULL THEN max(high) OVER (PARTITION BY {KS}, run_start ORDER BY bar_idx ROWS UNBOUNDED PRECEDING) END AS cons_high,
         CASE WHEN run_start IS NOT NULL THEN min(low) OVER (PARTITION BY {KS}, run_start ORDER BY bar_idx ROWS UNBOUNDED PRECEDING) END AS cons_low
       FROM rs),
lw AS (SELECT *, list({{'i': bar_idx, 'h': high, 'l': low, 'v': volume}}) OVER (w ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS win
       FROM ch {WIN}),
vv AS (SELECT *,
    coalesce(list_sum(list_transform(list_filter(win, lambda x: x.i >= run_start AND x.h >= 0.99 * cons_high), lambda x: x.v)), 0.0) AS vh,
    coalesce(list_sum(list_transform(list_filter(win, lambda x: x.i >= run_start AND x.l <= 1.01 * cons_low), lambda x: x.v)), 0.0) AS vl
  FROM lw WHERE is_narrow AND cons_bars >= 5),
im AS (SELECT *, CASE WHEN vh > 0 AND vl > 0 THEN (vh - vl) / greatest(vh, vl) * 100 ELSE 0.0 END AS simple_imbalance FROM vv)
SELECT {KS}, open_time, run_start, cons_bars, cons_high, cons_low, {rs('vh')} AS vol_at_high, {rs('vl')} AS vol_at_low,
  {rs('simple_imbalance')} AS simple_imbalance,
  CASE WHEN abs(simple_imbalance) >= 15.0 THEN CASE WHEN simple_imbalance > 0 THEN 'Resistance' ELSE 'Support' END END AS simple_type
FROM im"""


SQL["l9_simple_imbalance"] = _l9_sql()
