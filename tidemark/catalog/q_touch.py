"""Registered queries: first touch without a horizon (B2), breakouts of fixed ranges and the trades built on them
(L14, L15, L20-L22, B17-B19).  They run the operators of the live ranges on ranges that SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import sqlsrc
from tidemark.catalog.common import bars_all, shared
from tidemark.catalog.q_ranges import BASE, KS, RANGES_SQL, K, rnd
from tidemark.operators import indicators as I
from tidemark.operators import outcomes as B
from tidemark.operators import ranges as L
from tidemark.operators import series
from tidemark.operators import windows as W

QUERIES, SQL = {}, {}
rs = sqlsrc.rnd
SAME = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in K)


# ------------------------------------------------------------------ first touch

def b2_first_touch(spark, sf):
    """A long and a short from every bar's close, target 2 % and stop 1 % away, held until one is touched."""
    d = I.indexed(bars_all(spark, sf)).select(*K, F.col("bar_idx").alias("entry_idx"), F.col("close").alias("entry"))
    d = d.withColumn("side", F.explode(F.array(F.lit("long"), F.lit("short"))))
    sign = F.when(F.col("side") == "long", 1.0).otherwise(-1.0)
    d = d.withColumns({"tp": F.col("entry") * (1.0 + sign * 0.02), "stop": F.col("entry") * (1.0 - sign * 0.01)})
    t = B.first_barrier_hit(d, bars_all(spark, sf))
    return rnd(t.select(*K, "entry_idx", "side", "exit_idx", "exit_kind", "exit_price"), ["exit_price"])


SQL["b2_first_touch"] = BASE + f""",
e AS (SELECT {KS}, bar_idx AS entry_idx, side, sign, close * (1.0::DOUBLE + sign * 0.02::DOUBLE) AS tp, close * (1.0::DOUBLE - sign * 0.01::DOUBLE) AS stop
      FROM i, (VALUES ('long', 1.0::DOUBLE), ('short', -1.0::DOUBLE)) s(side, sign)),
h AS (SELECT {', '.join('e.' + k for k in K)}, entry_idx, side, min(x.bar_idx) AS exit_idx FROM e JOIN i x ON {SAME('x', 'e')} AND x.bar_idx > entry_idx
        AND (CASE WHEN side = 'long' THEN x.low <= stop OR x.high >= tp ELSE x.high >= stop OR x.low <= tp END) GROUP BY ALL),
o AS (SELECT e.*, h.exit_idx, CASE WHEN (side = 'long' AND x.low <= stop) OR (side = 'short' AND x.high >= stop) THEN 'stop' WHEN h.exit_idx IS NOT NULL THEN 'tp' END AS exit_kind
      FROM e LEFT JOIN h USING ({KS}, entry_idx, side) LEFT JOIN i x ON {SAME('x', 'e')} AND x.bar_idx = h.exit_idx)
SELECT {KS}, entry_idx, side, exit_idx, exit_kind, {rs("CASE exit_kind WHEN 'stop' THEN stop WHEN 'tp' THEN tp END")} AS exit_price FROM o"""


# ------------------------------------------------------------------ fixed ranges and their breakouts

def _known(spark, sf):
    """The fixed ranges with their volume degree and TPSL2 half a height beyond TPSL1."""
    bars = bars_all(spark, sf)
    r = L.fixed_ranges(bars, tpsl=(("auto", "half"),))
    v = series.halo_windows(I.indexed(bars), lambda w: {"vol_sma20": W.sma("volume", w, 20)}, back=20)
    r = L.J.null_safe_join(r, v.select(*K, F.col("bar_idx").alias("end_idx"), "vol_sma20"), [*K, "end_idx"], "left")
    return r.withColumn("vol_degree", L.volume_degree(F.col("avg_volume") * F.col("duration_bars"), F.col("vol_sma20"), F.col("duration_bars"))).drop("vol_sma20")


def _events(spark, sf):
    def build():
        r = series.pinned(_known(spark, sf))
        return L.range_breakouts(r, bars_all(spark, sf)).unionByName(L.range_activations(r).withColumn("close", F.lit(None).cast("double")))
    return shared(spark, sf, "fixed_events", build)


EV = RANGES_SQL + f""",
vs AS (SELECT {KS}, bar_idx AS end_idx, CASE WHEN count(volume) OVER w20 >= 20 THEN avg(volume) OVER w20 END AS vol_sma20 FROM i
       WINDOW w20 AS (PARTITION BY {KS} ORDER BY bar_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
kn AS (SELECT fr.* EXCLUDE (tpsl2_high, tpsl2_low), tpsl1_high + range_height / 2 AS tpsl2_high, tpsl1_low - range_height / 2 AS tpsl2_low,
         CASE WHEN avg_volume * duration_bars / NULLIF(vol_sma20 * duration_bars, 0) > 1.5 THEN 'High'
              WHEN avg_volume * duration_bars / NULLIF(vol_sma20 * duration_bars, 0) > 0.8 THEN 'Medium' ELSE 'Low' END AS vol_degree
       FROM fr LEFT JOIN vs USING ({KS}, end_idx)),
fb AS (SELECT {', '.join('kn.' + k for k in K)}, kn.start_idx, min(x.bar_idx) AS bar_idx FROM kn JOIN i x ON {SAME('x', 'kn')} AND x.bar_idx > end_idx
         AND (x.close > range_high + range_height * 0.005 OR x.close < range_low - range_height * 0.005) GROUP BY ALL),
ev AS (SELECT kn.*, fb.bar_idx, x.close, x.open_time, CASE WHEN x.close > range_high THEN 'breakout_up' ELSE 'breakout_down' END AS event,
         CASE WHEN x.close > range_high THEN 'long' ELSE 'short' END AS side
       FROM kn JOIN fb USING ({KS}, start_idx) JOIN i x ON {SAME('x', 'kn')} AND x.bar_idx = fb.bar_idx)"""


def l14_range_breakouts(spark, sf):
    e = _events(spark, sf).where(F.col("event").startswith("breakout"))
    return rnd(e.select(*K, "range_start_idx", "bar_idx", "open_time", "event", "close", "range_type", "vol_degree"), ["close"])


SQL["l14_range_breakouts"] = EV + f"""
SELECT {KS}, start_idx AS range_start_idx, bar_idx, open_time, event, {rs('close')} AS close, type AS range_type, vol_degree FROM ev"""


def l15_range_cancellation(spark, sf):
    e = L.breakout_cancellation(_events(spark, sf), bars_all(spark, sf))
    return e.select(*K, "range_start_idx", "bar_idx", "cancel_idx", "cancelled")


SQL["l15_range_cancellation"] = EV + f""",
pb AS (SELECT {KS}, bar_idx, close AS c, pc FROM i),
ca AS (SELECT {', '.join('ev.' + k for k in K)}, ev.start_idx, min(p.bar_idx) AS cancel_idx FROM ev JOIN pb p ON {SAME('p', 'ev')} AND p.bar_idx > ev.bar_idx
         AND p.c < range_high AND p.c > range_low AND CASE WHEN event = 'breakout_up' THEN p.pc > range_high ELSE p.pc < range_low END
         AND CASE WHEN type = 'Gravitation' THEN (1.0::DOUBLE - abs(p.c - (range_high + range_low) / 2) / ((range_high - range_low) / 2)) * 100 > 50
                  WHEN event = 'breakout_up' THEN (range_high - p.c) / (range_high - range_low) * 100 > 70 ELSE (p.c - range_low) / (range_high - range_low) * 100 > 70 END
       GROUP BY ALL)
SELECT {KS}, start_idx AS range_start_idx, bar_idx, cancel_idx, cancel_idx IS NOT NULL AS cancelled FROM ev LEFT JOIN ca USING ({KS}, start_idx)"""


def l20_range_accuracy(spark, sf):
    return L.directional_accuracy(_events(spark, sf))


_RIGHT = "count(*) FILTER ((type = 'Resistance' AND event = 'breakout_down') OR (type = 'Support' AND event = 'breakout_up'))"
SQL["l20_range_accuracy"] = EV + f"""
SELECT type AS range_type, event, count(*) AS n, {_RIGHT} AS n_correct FROM ev GROUP BY ALL
UNION ALL SELECT 'all', 'all', count(*), {_RIGHT} FROM ev WHERE type IN ('Resistance', 'Support')"""


# ------------------------------------------------------------------ held ranges

def l5_held_ranges(spark, sf):
    return rnd(L.held_ranges(bars_all(spark, sf)), ["imbalance"])


SQL["l5_held_ranges"] = BASE + f""",
n AS (SELECT {KS}, bar_idx, high, low, close, volume, coalesce(high - low < 1.5 * CASE WHEN count(high) OVER w20 >= 20 THEN avg(high - low) OVER w20 END, FALSE) AS nar
      FROM i WINDOW w20 AS (PARTITION BY {KS} ORDER BY bar_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
s AS (SELECT *, CASE WHEN nar AND NOT coalesce(lag(nar) OVER (PARTITION BY {KS} ORDER BY bar_idx), FALSE) THEN bar_idx END AS s0 FROM n),
r AS (SELECT *, max(s0) OVER (PARTITION BY {KS} ORDER BY bar_idx ROWS UNBOUNDED PRECEDING) AS rs FROM s),
e AS (SELECT *, max(high) OVER run AS top, min(low) OVER run AS bot FROM r WHERE nar WINDOW run AS (PARTITION BY {KS}, rs ORDER BY bar_idx ROWS UNBOUNDED PRECEDING)),
h AS (SELECT *, bar_idx > rs AND high >= top - (top - bot) * 0.1::DOUBLE AS ht, bar_idx > rs AND low <= bot + (top - bot) * 0.1::DOUBLE AS lt FROM e),
v AS (SELECT *, sum(ht::INT) OVER run AS nt, sum(CASE WHEN ht THEN volume ELSE 0 END) OVER run AS vt, sum(lt::INT) OVER run AS nb, sum(CASE WHEN lt THEN volume ELSE 0 END) OVER run AS vb
      FROM h WINDOW run AS (PARTITION BY {KS}, rs ORDER BY bar_idx ROWS UNBOUNDED PRECEDING)),
p AS (SELECT *, CASE WHEN nt > 0 THEN vt / nt ELSE 0 END AS pt, CASE WHEN nb > 0 THEN vb / nb ELSE 0 END AS pb FROM v),
c AS (SELECT {KS}, rs, bar_idx AS ci, top, bot, nt, nb, (pt - pb) / greatest(pt, pb) AS imb,
        CASE WHEN (pt - pb) / greatest(pt, pb) * 100 > 10 THEN 'Resistance' WHEN (pt - pb) / greatest(pt, pb) * 100 < -10 THEN 'Support' ELSE 'Gravitation' END AS type
      FROM p WHERE bar_idx - rs + 1 BETWEEN 8 AND 100 AND greatest(pt, pb) > 0),
f AS (SELECT {', '.join('c.' + k for k in K)}, ci, min(x.bar_idx) AS ei FROM c JOIN i x ON {SAME('x', 'c')} AND x.bar_idx >= ci AND CASE type
        WHEN 'Resistance' THEN x.close > top OR x.low < top - (top - bot) * 0.7::DOUBLE WHEN 'Support' THEN x.high > bot + (top - bot) * 0.7::DOUBLE OR x.close < bot
        ELSE x.close > top OR x.close < bot END GROUP BY ALL),
o AS (SELECT c.*, ei, coalesce(ei, 4611686018427387904) AS xe, CASE WHEN ei IS NULL THEN NULL WHEN x.close > top THEN 'breakout_up' WHEN x.close < bot THEN 'breakout_down' ELSE 'cancelled' END AS kind
      FROM c LEFT JOIN f USING ({KS}, ci) LEFT JOIN i x ON {SAME('x', 'c')} AND x.bar_idx = ei),
held(exchange, symbol, interval, ci, xe) AS (
  SELECT {KS}, ci, xe FROM (SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY ci) AS rn FROM o) WHERE rn = 1
  UNION ALL SELECT q.exchange, q.symbol, q.interval, q.ci, q.xe FROM held, LATERAL (SELECT o.* FROM o WHERE {SAME('o', 'held')} AND o.ci > held.xe ORDER BY o.ci LIMIT 1) q)
SELECT {KS}, rs AS range_start_idx, ci AS confirm_idx, top AS range_high, bot AS range_low, type AS range_type, {rs('imb')} AS imbalance, nt::BIGINT AS touches_high,
  nb::BIGINT AS touches_low, ei AS end_idx, kind AS end_kind FROM o JOIN held USING ({KS}, ci)"""


# ------------------------------------------------------------------ trades

TRADE = ["trade_id", "entry_idx", "side", "entry", "stop", "tp", "exit_idx", "exit_kind", "exit_price", "r_multiple"]
TRADE_DBL = ["entry", "stop", "tp", "exit_price", "r_multiple"]


def _trades(spark, sf, **kw):
    return B.range_trades(_events(spark, sf), bars_all(spark, sf), **{"one_position": False, **kw})


def exits(entries: str, name: str, stop: str = "stop", tp: str = "tp") -> str:
    """CTEs that resolve ``entries`` (key, trade_id, entry_idx, side, stop, tp): ``name`` adds exit_idx, exit_kind, exit_price."""
    return f"""
{name}_h AS (SELECT trade_id, min(x.bar_idx) AS exit_idx FROM {entries} e JOIN i x ON {SAME('x', 'e')} AND x.bar_idx > entry_idx
   AND (CASE WHEN side = 'long' THEN coalesce(x.low <= {stop}, FALSE) OR coalesce(x.high >= {tp}, FALSE)
             ELSE coalesce(x.high >= {stop}, FALSE) OR coalesce(x.low <= {tp}, FALSE) END) GROUP BY trade_id),
{name}_k AS (SELECT e.*, h.exit_idx, CASE WHEN h.exit_idx IS NULL THEN NULL
     WHEN coalesce(CASE WHEN side = 'long' THEN x.low <= {stop} ELSE x.high >= {stop} END, FALSE) THEN 'stop' ELSE 'tp' END AS exit_kind
   FROM {entries} e LEFT JOIN {name}_h h USING (trade_id) LEFT JOIN i x ON {SAME('x', 'e')} AND x.bar_idx = h.exit_idx),
{name} AS (SELECT *, CASE exit_kind WHEN 'stop' THEN {stop} WHEN 'tp' THEN {tp} END AS exit_price FROM {name}_k)"""


R = "CASE WHEN abs(entry - stop) > 0 THEN (CASE WHEN side = 'long' THEN exit_price - entry ELSE entry - exit_price END) / abs(entry - stop) END"
ENTRIES = f"""en AS (SELECT {KS}, sha256(concat_ws('::', {KS}, CAST(bar_idx AS VARCHAR), event, CAST(start_idx AS VARCHAR))) AS trade_id, bar_idx AS entry_idx, side, close AS entry,
  CASE WHEN side = 'long' THEN range_low - range_height * 50.0 / 100.0 ELSE range_high + range_height * 50.0 / 100.0 END AS stop,
  CASE WHEN side = 'long' THEN tpsl1_high ELSE tpsl1_low END AS tp, CASE WHEN side = 'long' THEN tpsl2_high ELSE tpsl2_low END AS tp2, type, vol_degree, imbalance FROM ev)"""
TR = EV + ",\n" + ENTRIES + "," + exits("en", "xt") + f""",
tr AS (SELECT *, {R} AS r_multiple FROM xt)"""


def _out(select: str, table: str) -> str:
    cols = ", ".join(f"{rs(c)} AS {c}" if c in TRADE_DBL else c for c in TRADE)
    return f"{select}SELECT {KS}, {cols} FROM {table}"


def b17_fixed_trades(spark, sf):
    return rnd(_trades(spark, sf).select(*K, *TRADE), TRADE_DBL)


SQL["b17_fixed_trades"] = _out(TR + "\n", "tr")


def b17_fixed_one_position(spark, sf):
    t = _trades(spark, sf, one_position=True, min_toi="Medium")
    return t.select(*K, "trade_id", "entry_idx", "exit_idx")


SQL["b17_fixed_one_position"] = TR + f""",
nt AS (SELECT *, coalesce(exit_idx, 4611686018427387904) AS x_end FROM tr WHERE vol_degree IN ('Medium', 'High')),
one(exchange, symbol, interval, trade_id, entry_idx, exit_idx, x_end) AS (
  SELECT {KS}, trade_id, entry_idx, exit_idx, x_end FROM (SELECT *, row_number() OVER (PARTITION BY {KS} ORDER BY entry_idx, trade_id) AS rn FROM nt) WHERE rn = 1
  UNION ALL
  SELECT n.exchange, n.symbol, n.interval, n.trade_id, n.entry_idx, n.exit_idx, n.x_end FROM one c, LATERAL (
    SELECT x.* FROM nt x WHERE {SAME('x', 'c')} AND x.entry_idx > c.x_end ORDER BY x.entry_idx, x.trade_id LIMIT 1) n)
SELECT {KS}, trade_id, entry_idx, exit_idx FROM one"""


def l21_fixed_win_rates(spark, sf):
    t = _trades(spark, sf).withColumn("imb_band", L.imbalance_band(F.col("imbalance") * 100))
    win = F.avg(F.when(F.col("r_multiple") > 0, 1.0).otherwise(0.0))
    parts = [t.groupBy(F.lit(dim).alias("dimension"), F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.round(win, 6).alias("win_rate"))
             for dim, col in (("vol_degree", "vol_degree"), ("imbalance_band", "imb_band"), ("range_type", "range_type"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_WIN = f"count(*) AS n, {rs('avg(CASE WHEN r_multiple > 0 THEN 1.0 ELSE 0.0 END)')} AS win_rate FROM tr GROUP BY ALL"
SQL["l21_fixed_win_rates"] = TR + f"""
SELECT 'vol_degree' AS dimension, vol_degree AS value, {_WIN} UNION ALL SELECT 'range_type', type, {_WIN}
UNION ALL SELECT 'imbalance_band', CASE WHEN abs(imbalance * 100) < 10 THEN '<10' WHEN abs(imbalance * 100) < 15 THEN '10-15' WHEN abs(imbalance * 100) <= 20 THEN '15-20' ELSE '>20' END, {_WIN}"""


def l22_fixed_tpsl_hits(spark, sf):
    out = []
    for level, second in (("tpsl1", False), ("tpsl2", True)):
        t = _trades(spark, sf, use_tpsl2=second)
        hit = F.col("exit_kind") == "tp"
        out.append(t.groupBy("range_type").agg(F.lit(level).alias("level"), F.count(F.lit(1)).alias("n"), F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("hit_rate"),
                                               F.avg(F.when(hit, F.col("exit_idx") - F.col("entry_idx"))).alias("mean_bars_to_target")))
    return rnd(out[0].unionByName(out[1]), ["hit_rate", "mean_bars_to_target"])


def _hits(level: str, table: str) -> str:
    return (f"SELECT type AS range_type, '{level}' AS level, count(*) AS n, {rs('''avg(CASE WHEN exit_kind = 'tp' THEN 1.0 ELSE 0.0 END)''')} AS hit_rate, "
            f"{rs('''avg(exit_idx - entry_idx) FILTER (exit_kind = 'tp')''')} AS mean_bars_to_target FROM {table} GROUP BY type")


SQL["l22_fixed_tpsl_hits"] = TR + "," + exits("en", "x2", tp="tp2") + f"""
{_hits('tpsl1', 'tr')} UNION ALL {_hits('tpsl2', 'x2')}"""


def b18_fixed_retests(spark, sf):
    t = B.retest_trades(_events(spark, sf), bars_all(spark, sf))
    return rnd(t.select(*K, *TRADE), TRADE_DBL)


SQL["b18_fixed_retests"] = _out(EV + f""",
rt2 AS (SELECT {', '.join('ev.' + k for k in K)}, ev.start_idx, min(x.bar_idx) AS hit_at FROM ev JOIN i x ON {SAME('x', 'ev')} AND x.bar_idx > ev.bar_idx
        AND CASE WHEN side = 'long' THEN x.low <= range_high ELSE x.high >= range_low END GROUP BY ALL),
en AS (SELECT {KS}, sha256(concat_ws('::', {KS}, CAST(bar_idx AS VARCHAR), event, CAST(start_idx AS VARCHAR))) AS trade_id, hit_at AS entry_idx, side,
         CASE WHEN side = 'long' THEN range_high ELSE range_low END AS entry,
         CASE WHEN side = 'long' THEN range_low - range_height * 50.0 / 100.0 ELSE range_high + range_height * 50.0 / 100.0 END AS stop,
         CASE WHEN side = 'long' THEN tpsl1_high ELSE tpsl1_low END AS tp FROM ev JOIN rt2 USING ({KS}, start_idx)),""" + exits("en", "xt") + f""",
tr AS (SELECT *, {R} AS r_multiple FROM xt)
""", "tr")


def b18_fixed_fades(spark, sf):
    t = B.fade_trades(_events(spark, sf), bars_all(spark, sf), heights=0.02)  # these ranges are some 50 bars wide
    return rnd(t.select(*K, *TRADE), TRADE_DBL)


SQL["b18_fixed_fades"] = _out(EV + f""",
fd AS (SELECT {', '.join('kn.' + k for k in K)}, kn.start_idx, min(x.bar_idx) AS hit_at FROM kn JOIN i x ON {SAME('x', 'kn')} AND x.bar_idx > end_idx AND type = 'Gravitation'
        AND (x.close > range_high + range_height * 0.02 OR x.close < range_low - range_height * 0.02) GROUP BY ALL),
en AS (SELECT {', '.join('kn.' + k for k in K)}, sha256(concat_ws('::', {', '.join('kn.' + k for k in K)}, CAST(end_idx AS VARCHAR), CAST(kn.start_idx AS VARCHAR))) AS trade_id, hit_at AS entry_idx, x.close AS entry,
         CASE WHEN x.close > range_high THEN 'short' ELSE 'long' END AS side, (range_high + range_low) / 2 AS tp,
         CASE WHEN x.close > range_high THEN CASE WHEN tpsl1_high > x.close THEN tpsl1_high END ELSE CASE WHEN tpsl1_low < x.close THEN tpsl1_low END END AS stop
       FROM kn JOIN fd USING ({KS}, start_idx) JOIN i x ON {SAME('x', 'kn')} AND x.bar_idx = hit_at),""" + exits("en", "xt") + f""",
tr AS (SELECT *, {R} AS r_multiple FROM xt)
""", "tr")


def b19_fixed_scaled(spark, sf):
    t = B.scaled_exit_trades(_trades(spark, sf), _trades(spark, sf, use_tpsl2=True), 0.5)
    return rnd(t, ["r_leg1", "r_leg2", "r_multiple"])


SQL["b19_fixed_scaled"] = TR + "," + exits("en", "x2", tp="tp2") + f""",
l2 AS (SELECT trade_id, exit_idx AS exit_idx_leg2, {R} AS r2 FROM x2)
SELECT trade_id, {KS}, entry_idx, side, {rs('r_multiple')} AS r_leg1, {rs('r2')} AS r_leg2, exit_idx_leg2, {rs('0.5::DOUBLE * r_multiple + 0.5::DOUBLE * r2')} AS r_multiple
FROM tr JOIN l2 USING (trade_id)"""


def b19_fixed_staged(spark, sf):
    a = _trades(spark, sf)
    b = _trades(spark, sf, use_tpsl2=True).select("trade_id", F.col("tp").alias("tp2"))
    t = a.join(b, "trade_id").select(*K, "trade_id", "entry_idx", "side", "entry", "stop", F.col("tp").alias("tp1"), "tp2")
    s = B.staged_exits(t, bars_all(spark, sf))
    return rnd(s.select("trade_id", *[f"exit_{x}_{n}" for n in "123" for x in ("idx", "kind")], "r_multiple"), ["r_multiple"])


_RR = "(CASE WHEN side = 'long' THEN {p} - entry ELSE entry - {p} END) / abs(entry - stop)"
SQL["b19_fixed_staged"] = TR + f""",
e2 AS (SELECT {KS}, trade_id, exit_idx AS entry_idx, side, entry AS stop, tp2 AS tp FROM tr WHERE exit_kind = 'tp'),""" + exits("e2", "xb") + f""",
e3 AS (SELECT {', '.join('xb.' + k for k in K)}, trade_id, xb.exit_idx AS entry_idx, xb.side, tr.tp AS stop, NULL::DOUBLE AS tp FROM xb JOIN tr USING (trade_id) WHERE xb.exit_kind = 'tp'),""" + exits("e3", "xc") + f""",
al AS (SELECT tr.trade_id, tr.side, tr.entry, tr.stop, tr.tp, tr.tp2, tr.exit_idx AS i1, tr.exit_kind AS k1, xb.exit_idx AS i2, xb.exit_kind AS k2, xc.exit_idx AS i3, xc.exit_kind AS k3
       FROM tr LEFT JOIN xb USING (trade_id) LEFT JOIN xc USING (trade_id)),
rr AS (SELECT *, CASE WHEN k1 = 'stop' THEN {_RR.format(p='stop')} WHEN k1 = 'tp' THEN 0.5::DOUBLE * ({_RR.format(p='tp')}) + CASE WHEN k2 = 'stop' THEN 0.0::DOUBLE
         WHEN k3 = 'stop' THEN 0.3::DOUBLE * ({_RR.format(p='tp2')}) + 0.2::DOUBLE * ({_RR.format(p='tp')}) END END AS r FROM al)
SELECT trade_id, i1 AS exit_idx_1, k1 AS exit_kind_1, i2 AS exit_idx_2, k2 AS exit_kind_2, i3 AS exit_idx_3, k3 AS exit_kind_3, {rs('r')} AS r_multiple FROM rr"""


for _n, _f in list(globals().items()):
    if callable(_f) and _n[:1] in ("l", "b") and _n[1:2].isdigit():
        QUERIES[_n] = _f
