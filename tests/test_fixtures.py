"""Small hand-made cases (FIXTURES.md §3)."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins as J
from tidemark.operators import outcomes as B
from tidemark.operators import quality as Q
from tidemark.operators import ranges as L
from tidemark.operators import series
from tidemark.operators import snapshots as N

H = 3_600_000


def bars(spark, rows, interval="1h"):
    """rows: (open_time, open, high, low, close[, volume])"""
    data = [("X", "S", interval, int(t), int(t) + H - 1, float(o), float(h), float(lo), float(c),
             float(r[5] if len(r) > 5 else 1.0)) for r in rows for (t, o, h, lo, c) in [r[:5]]]
    return spark.createDataFrame(data, "exchange string, symbol string, interval string, open_time long, "
                                       "close_time long, open double, high double, low double, close double, "
                                       "volume double")


def test_bar_quality(spark):
    b = bars(spark, [(0, 1, 2, 0.5, 1.5), (H, 1, 2, 0.5, 1.5), (H, 1, 2, 0.5, 1.5), (3 * H, 1, 0.5, 2, 1.5)])
    q = Q.bar_quality(b).first()
    assert (q.bars, q.gap_bars, q.dup_bars, q.invalid_bars) == (4, 2, 1, 1)


def test_imbalance_and_type(spark):
    r = spark.range(1).select(L.imbalance(F.lit(100.0), F.lit(80.0)).alias("imb"))
    r = r.withColumn("t", L.range_type(F.col("imb"), 0.15)).first()
    assert abs(r.imb - 0.2) < 1e-12 and r.t == "Resistance"


def test_volume_degree(spark):
    df = spark.createDataFrame([(1.6,), (1.0,), (0.5,)], "r double")
    out = [x.d for x in df.select(L.volume_degree(F.col("r") * 10, F.lit(10.0), F.lit(1.0)).alias("d")).collect()]
    assert out == ["High", "Medium", "Low"]


def test_breakout_margin(spark):
    m = L.RangeTracker()
    open_range = {"range_high": 110.0, "range_low": 100.0}
    assert m.broken(open_range, 110.04) is None and m.broken(open_range, 99.96) is None
    assert m.broken(open_range, 110.06) == "breakout_up" and m.broken(open_range, 99.94) == "breakout_down"


@pytest.mark.parametrize("swing,expected", [(108.0, 120.0), (115.0, 115.0), (None, 120.0)])
def test_tpsl1_auto(spark, swing, expected):
    rng = spark.createDataFrame([("X", "S", "1h", 20, 110.0, 100.0, 10.0)],
                                "exchange string, symbol string, interval string, start_idx long, range_high double, "
                                "range_low double, range_height double")
    rows = [("X", "S", "1h", i, 100.0, 99.0, i == 15 and swing is not None, False) for i in range(20)]
    rows = [(a, b_, c, i, (swing if flag else h), lo, flag, fl) for a, b_, c, i, h, lo, flag, fl in rows]
    sw = spark.createDataFrame(rows, "exchange string, symbol string, interval string, bar_idx long, high double, "
                                     "low double, swing_high boolean, swing_low boolean")
    out = L.with_tpsl(rng, sw).first()
    assert out.tpsl1_high == expected


def test_sizing(spark):
    r = spark.range(1).select(B.risk_size(10_000.0, 1.0, F.lit(100.0), F.lit(98.0)).alias("u")).first()
    assert abs(r.u - 50.0) < 1e-9


@pytest.mark.parametrize("policy,label", [("tp_first", 1), ("sl_first", 0), ("discard_both", None)])
def test_barrier_same_bar(spark, policy, label):
    rows = [(i * H, 100.0, 100.5, 99.5, 100.0) for i in range(5)]
    rows[3] = (3 * H, 100.0, 200.0, 1.0, 100.0)  # TP and SL both hit on bar 3
    b = bars(spark, rows).withColumn("atr", F.lit(1.0))
    out = B.barrier_labels(b, 3.0, 2.0, 24, policy).where("bar_idx = 0").first()
    assert out.label == label and out.ambiguous_same_bar == 1


def test_plan_fill_on_bar_2(spark):
    rows = [(0, 102, 103, 101, 102), (H, 100, 101, 99, 100), (2 * H, 100, 130, 99, 120)]
    b = bars(spark, rows)
    plans = spark.createDataFrame([(1, 1, 0, "X", "S", "1h", "BUY", 100.0, 90.0, 110.0, None, None)],
                                  "plan_id long, alert_id long, plan_ts long, exchange string, symbol string, "
                                  "tf string, side string, entry_price double, stop_loss double, tp1 double, "
                                  "tp2 double, tp3 double")
    t = B.plan_trades(plans, b, B.PlanConfig(window_days=1)).first()
    assert t.event == "TP1" and t.bars_to_resolve == 1.0 and abs(t.r_multiple - 1.0) < 1e-12


@pytest.mark.parametrize("rows_per_block", [4, 1000])
def test_backward_scans_run_in_falling_order(spark, rows_per_block):
    """Spark evaluates a frame up to the end of its partition anew for every row, so a dense block took forever."""
    ticks = [("a", (7 * i) % 50, float(i) if i % 3 == 0 else None) for i in range(40)] + [(None, 3, None), (None, 9, 1.0)]
    d = spark.createDataFrame(ticks, "k string, t long, v double")
    blk = F.floor(F.col("t") / F.lit(rows_per_block)).cast("long")
    scanned = J.scan_carry(d, ["v"], ["k"], ["t", "v"], blk, forward=False)
    carried = series.carry_last(d, ["v"], key=["k"], order=["t"], idx="t", forward=False)
    for out in (scanned, carried):
        assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower()
        for r in out.where("k IS NULL OR v IS NOT NULL OR t % 3 = 0").collect():
            later = sorted((t, v) for k, t, v in ticks if k == r.k and t >= r.t and v is not None)
            assert r.v_carried == (later[0][1] if later else None)
    left = spark.createDataFrame([("a", t) for t in range(55)] + [(None, 4), (None, 10)], "k string, t long")
    got = J.asof_forward(left, d.where("v IS NOT NULL"), "t", ["k"], ["v"], grain=rows_per_block)
    assert "unboundedfollowing" not in got._jdf.queryExecution().toString().lower()
    for r in got.collect():
        later = sorted((t, v) for k, t, v in ticks if k == r.k and t >= r.t and v is not None)
        assert (r.r_t, r.r_v) == (later[0] if later else (None, None))


def test_asof_backward_tolerance(spark):
    left = spark.createDataFrame([("k", 10)], "g string, t long")
    right = spark.createDataFrame([("k", 5, 5.0), ("k", 9, 9.0), ("k", 11, 11.0)], "g string, t long, v double")
    a = J.asof_backward(left, right, "t", ["g"], ["v"]).first()
    assert a.r_v == 9.0
    b = J.asof_backward(left, right, "t", ["g"], ["v"], tolerance=0).first()
    assert b.r_v is None and b.t == 10


def test_dedup_buckets(spark):
    a = spark.createDataFrame([(1, 59 * 60_000, "X", "S", "BUY", "1h"), (2, 61 * 60_000, "X", "S", "BUY", "1h")],
                              "id long, ts long, exchange string, symbol string, signal string, source_tf string")
    assert B.dedup_alerts(a).count() == 2


def test_fixed_range_starts(spark, tiny_blocks):
    n = 200
    narrow = {1, 5, 60, 70, 130}
    rows = []
    for i in range(n):
        w = 0.1 if i in narrow else 10.0
        rows.append((i * H, 100.0, 100.0 + w / 2, 100.0 - w / 2, 100.0))
    b = bars(spark, rows).withColumn("atr", F.lit(1.0)).withColumn("bar_idx", (F.col("open_time") / H).cast("long"))
    b = b.withColumn("is_narrow", F.col("high") - F.col("low") < 0.5 * F.col("atr"))
    st = sorted(r.start_idx for r in L.range_starts(b, 50).collect())
    assert st == [1, 60, 130]


def test_snapshot_wrappers(spark):
    docs = ['[{"symbol":"A"}]', '{"data":[{"symbol":"B"}]}', '{"data":{"items":[{"symbol":"C"}]}}',
            '{"zzz":[{"symbol":"D"}]}', '{bad']
    df = spark.createDataFrame([(i, "x", i, d) for i, d in enumerate(docs)],
                               "id long, exchange string, ts long, snapshot_json string")
    got = sorted((r.snapshot_id, r.symbol) for r in N.snapshot_rows(df).collect())
    assert got == [(0, "A"), (1, "B"), (2, "C"), (3, "D")]


def test_no_lookahead(spark):
    """Dropping the last k bars leaves earlier feature rows unchanged."""
    from tidemark.operators import indicators as I
    rows = [(i * H, 100 + math.sin(i), 101 + math.sin(i), 99 + math.sin(i), 100 + math.cos(i), 1.0 + i % 3)
            for i in range(120)]
    full = I.tech_features(bars(spark, rows)).where("bar_idx < 100")
    cut = I.tech_features(bars(spark, rows[:100]))
    cols = ["bar_idx", "ema_20", "rsi_14", "macd_hist", "adx_14", "bb_bw_20"]
    a = full.select(*cols).toPandas().sort_values("bar_idx").reset_index(drop=True)
    b = cut.select(*cols).toPandas().sort_values("bar_idx").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, rtol=1e-12)
