"""Registered queries: live ranges and their trades (L5, L14-L16, L20-L22,
B17-B19, B24, B25).  Sequential state machines have no SQL statement; they
are checked by parity tests (tests/test_statemachine.py)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.common import bars_all, prep, shared
from tidemark.catalog.q_outcomes import _grid as _grid_trades
from tidemark.operators import outcomes as B
from tidemark.operators import ranges as L
from tidemark.operators import signals as G
from tidemark.catalog import sqlsrc
from tidemark.catalog.q_outcomes import PERF_COLS, _b7_raw_sql, perf_sql, rnd
from tidemark.sources import adapters as A

QUERIES, SQL = {}, {}
K = ["exchange", "symbol", "interval"]


def _events(spark, sf):
    return shared(spark, sf, "live_ranges", lambda: L.live_ranges(bars_all(spark, sf)))


def l5_l14_live_ranges(spark, sf):
    return _events(spark, sf)


def l15_cancellation(spark, sf):
    return L.breakout_cancellation(_events(spark, sf), bars_all(spark, sf))


def l16_htf_gate(spark, sf):
    prep(spark)
    return L.htf_consolidation(A.bars_events(spark, sf, "1h"), "4h").select(*K, "open_time", "htf_ok")


def l20_directional_accuracy(spark, sf):
    return L.directional_accuracy(_events(spark, sf))


def _range_trades(spark, sf, **kw):
    return B.range_trades(_events(spark, sf), bars_all(spark, sf), **kw)


def b17_range_trades(spark, sf):
    return _range_trades(spark, sf, method="Breakout")


def b17_immediate_trades(spark, sf):
    return _range_trades(spark, sf, method="Immediate")


def l21_win_rates(spark, sf):
    t = _range_trades(spark, sf, method="Breakout").withColumn("imb_band", L.imbalance_band(F.col("imbalance") * 100))
    win = F.avg(F.when(F.col("r_multiple") > 0, 1.0).otherwise(0.0))
    parts = [t.groupBy(F.lit(dim).alias("dimension"), F.col(col).alias("value"))
             .agg(F.count(F.lit(1)).alias("n"), win.alias("win_rate"))
             for dim, col in (("vol_degree", "vol_degree"), ("imbalance_band", "imb_band"), ("range_type", "range_type"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def l22_tpsl_hits(spark, sf):
    """TPSL1 / TPSL2 hit rate and mean bars to target per range type (every
    breakout, not only those a single position could take)."""
    out = []
    for lvl, use2 in (("tpsl1", False), ("tpsl2", True)):
        t = _range_trades(spark, sf, method="Breakout", use_tpsl2=use2, one_position=False)
        out.append(t.groupBy("range_type").agg(
            F.lit(lvl).alias("level"), F.count(F.lit(1)).alias("n"),
            F.avg(F.when(F.col("exit_kind") == "tp", 1.0).otherwise(0.0)).alias("hit_rate"),
            F.avg(F.when(F.col("exit_kind") == "tp", F.col("exit_idx") - F.col("entry_idx"))).alias("mean_bars_to_target")))
    return out[0].unionByName(out[1])


def b18_retest_entries(spark, sf):
    return B.retest_entries(_events(spark, sf), bars_all(spark, sf))


def b18_gravitation_fade(spark, sf):
    return B.gravitation_fade(_events(spark, sf), bars_all(spark, sf))


def b19_scaled_exits(spark, sf):
    t1 = _range_trades(spark, sf, method="Breakout", use_tpsl2=False, one_position=False)
    t2 = _range_trades(spark, sf, method="Breakout", use_tpsl2=True, one_position=False)
    return B.scaled_exit_trades(t1, t2, 0.5)


def b18_retest_trades(spark, sf):
    return B.retest_trades(_events(spark, sf), bars_all(spark, sf))


def b18_fade_trades(spark, sf):
    return B.fade_trades(_events(spark, sf), bars_all(spark, sf))


def b19_staged_exits(spark, sf):
    """50 / 30 / 20 exits of every breakout trade."""
    t1 = _range_trades(spark, sf, method="Breakout", use_tpsl2=False, one_position=False)
    t2 = _range_trades(spark, sf, method="Breakout", use_tpsl2=True, one_position=False).select("trade_id", F.col("tp").alias("tp2"))
    t = t1.join(t2, "trade_id").select(*K, "trade_id", "entry_idx", "side", "entry", "stop", F.col("tp").alias("tp1"), "tp2")
    return B.staged_exits(t, bars_all(spark, sf))


def _grid(spark, sf):
    t = _grid_trades(spark, sf)
    return t.withColumn("trade_id", F.sha2(F.concat_ws("::", *[F.col(k) for k in K], F.col("entry_time_utc").cast("string"),
                                                       F.col("max_hold_bars").cast("string"),
                                                       F.col("atr_mult_stop").cast("string")), 256))


def b24_monte_carlo(spark, sf):
    return rnd(B.monte_carlo_drawdown(_grid(spark, sf), ["exchange", "symbol", "interval", "atr_mult_stop"], runs=1000),
               ["mean_max_dd", "p50_max_dd", "p95_max_dd", "worst_max_dd"])


_MC = "exchange, symbol, interval, atr_mult_stop"
_B28 = lambda x: f"('0x' || substr(md5({x}), 1, 7))::BIGINT"
SQL["b24_monte_carlo"] = f"""WITH t AS (SELECT {_MC}, coalesce(r_multiple, 0) AS r, sha256(concat_ws('::', exchange, symbol, interval, CAST(entry_time_utc AS VARCHAR),
         CAST(max_hold_bars AS VARCHAR), CAST(atr_mult_stop AS VARCHAR))) AS id FROM ({_b7_raw_sql()})),
p AS (SELECT run, {_B28("'a:7:' || run")} + 1 AS a, {_B28("'b:7:' || run")} AS b, {_B28("'c:7:' || run")} AS c FROM range(1000) x(run)),
o AS (SELECT {_MC}, run, r, id, (h * a + (h * h % 2147483647) * c + b) % 2147483647 AS k FROM (SELECT *, {_B28('id')} AS h FROM t), p),
e AS (SELECT {_MC}, run, k, id, sum(r) OVER (PARTITION BY {_MC}, run ORDER BY k, id ROWS UNBOUNDED PRECEDING) AS eq FROM o),
d AS (SELECT {_MC}, run, eq - greatest(0, max(eq) OVER (PARTITION BY {_MC}, run ORDER BY k, id ROWS UNBOUNDED PRECEDING)) AS dd FROM e),
m AS (SELECT {_MC}, run, min(dd) AS max_dd FROM d GROUP BY ALL)
SELECT {_MC}, count(*) AS runs, {sqlsrc.rnd('avg(max_dd)')} AS mean_max_dd, {sqlsrc.rnd('quantile_cont(max_dd, 0.5)')} AS p50_max_dd,
  {sqlsrc.rnd('quantile_cont(max_dd, 0.05)')} AS p95_max_dd, {sqlsrc.rnd('min(max_dd)')} AS worst_max_dd FROM m GROUP BY ALL"""


def b25_walk_forward(spark, sf):
    from tidemark.functions import timeutil as TU
    t = _grid(spark, sf).withColumn("exit_ms", F.unix_millis("exit_time_utc"))
    t = t.withColumn("split", TU.time_split(F.unix_millis("entry_time_utc"), 978_307_200_000, 1_705_536_000_000))
    return rnd(B.walk_forward(t, ["exchange", "symbol", "atr_mult_stop"]), PERF_COLS)


SQL["b25_walk_forward"] = perf_sql(
    "exchange, symbol, atr_mult_stop, split",
    ", CASE WHEN epoch_ms(entry_time_utc) < 978307200000 THEN 'train' "
    "WHEN epoch_ms(entry_time_utc) < 1705536000000 THEN 'valid' ELSE 'test' END AS split")


for _n, _f in list(globals().items()):
    if callable(_f) and _n[:1] in ("l", "b") and _n[1:2].isdigit():
        QUERIES[_n] = _f


def _l16_sql():
    from tidemark.catalog.q_misc import _resample_sql
    return f"""WITH h AS ({_resample_sql('4h')}),
hi AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol ORDER BY open_time) - 1 AS bar_idx FROM h),
hs AS (SELECT exchange, symbol, close_time + 1 AS t,
         (high - low) < 1.2 * CASE WHEN count(high) OVER w >= 20 THEN avg(high - low) OVER w END AS ok
       FROM hi WINDOW w AS (PARTITION BY exchange, symbol ORDER BY bar_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
b AS ({sqlsrc.bars_events('1h')})
SELECT b.exchange, b.symbol, b.interval, b.open_time, coalesce(hs.ok, FALSE) AS htf_ok
FROM b ASOF LEFT JOIN hs ON b.exchange = hs.exchange AND b.symbol = hs.symbol AND b.open_time >= hs.t"""


SQL["l16_htf_gate"] = _l16_sql()
