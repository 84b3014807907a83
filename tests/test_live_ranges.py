"""Live ranges, cancellations and fades against plain loops over one small series."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins as J
from tidemark.operators import outcomes as B
from tidemark.operators import ranges as L
from tidemark.operators import signals as G
from tidemark.operators import stats

K = ("X", "S", "1h")


def series(n, seed, calm=0.75):
    rnd, rows, px = random.Random(seed), [], 100.0
    for i in range(n):
        wide = rnd.random() > calm
        move = rnd.uniform(-4, 4) if wide else rnd.uniform(-0.4, 0.4)
        o, c = px, px + move
        h, lo = max(o, c) + rnd.uniform(0, 0.3), min(o, c) - rnd.uniform(0, 0.3)
        rows.append((*K, i * 3_600_000, i * 3_600_000 + 3_599_999, o, h, lo, c, float(rnd.randint(1, 50)), rnd.random() < 0.8))
        px = c
    return rows


@pytest.fixture(scope="module")
def bars(spark):
    return spark.createDataFrame(series(700, 3), "exchange string, symbol string, interval string, open_time long, close_time long, "
                                                 "open double, high double, low double, close double, volume double, htf_ok boolean")


def expected_ranges(rows, gate):
    """All ranges by looking back from every bar: O(n * run), no state but the last breakout."""
    trs = [r[6] - r[7] if i == 0 else max(r[6] - r[7], abs(r[6] - rows[i - 1][8]), abs(r[7] - rows[i - 1][8])) for i, r in enumerate(rows)]
    atr = [None] * 13 + [sum(trs[:14]) / 14]
    for t in trs[14:]:
        atr.append(atr[-1] + (t - atr[-1]) / 14)
    ok = [a is not None and r[6] - r[7] < 0.8 * a and (r[10] or not gate) for r, a in zip(rows, atr)]
    out, free, i = [], 0, 0
    while i < len(rows):
        start = i
        while start > free and ok[start - 1] and ok[i]:
            start -= 1
        if not ok[i] or i - start + 1 < 8:
            i += 1
            continue
        run = rows[start:i + 1]
        top = [max(r[6] for r in run[:k + 1]) for k in range(len(run))]
        low = [min(r[7] for r in run[:k + 1]) for k in range(len(run))]
        hits = [sum(r[6] >= t - 0.1 * (t - b) for r, t, b in list(zip(run, top, low))[1:]), sum(r[7] <= b + 0.1 * (t - b) for r, t, b in list(zip(run, top, low))[1:])]
        if not any(hits):
            i += 1
            continue
        out.append(("activated", i, start, top[-1], low[-1], *hits))
        j = next((j for j in range(i + 1, len(rows)) if rows[j][8] > top[-1] + 0.005 * (top[-1] - low[-1]) or rows[j][8] < low[-1] - 0.005 * (top[-1] - low[-1])), None)
        if j is None:
            break
        out.append(("breakout_up" if rows[j][8] > top[-1] else "breakout_down", j, start, top[-1], low[-1], *hits))
        free = i = j + 1
    return out


@pytest.mark.parametrize("gate", [False, True])
def test_live_ranges_by_looking_back(spark, bars, gate):
    rows = [tuple(r) for r in bars.orderBy("open_time").collect()]
    got = L.live_ranges(bars, L.RangeTracker(require_htf=gate)).select("event", "bar_idx", "range_start_idx", "range_high", "range_low", "touches_high", "touches_low")
    want = expected_ranges(rows, gate)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) >= 4


def test_the_gate_needs_its_column(bars):
    with pytest.raises(ValueError):
        L.live_ranges(bars.drop("htf_ok"), L.RangeTracker(require_htf=True))


def event(spark, kind, name="breakout_up"):
    return spark.createDataFrame([(*K, 0, name, kind, 110.0, 100.0)], "exchange string, symbol string, interval string, bar_idx long, event string, "
                                                                     "range_type string, range_high double, range_low double")


def closes(spark, values):
    rows = [(*K, i * 3_600_000, i * 3_600_000 + 1, c, c, c, c, 1.0) for i, c in enumerate(values)]
    return spark.createDataFrame(rows, "exchange string, symbol string, interval string, open_time long, close_time long, open double, high double, low double, close double, volume double")


def test_late_cancellation_and_crossing(spark):
    late = closes(spark, [111.0] * 300 + [101.0, 101.0])  # a return 300 bars later
    assert L.breakout_cancellation(event(spark, "Resistance"), late).first().cancel_idx == 300
    slow = closes(spark, [111.0, 109.0, 101.0, 111.0])  # comes back in two steps: no bar crosses far enough
    assert not L.breakout_cancellation(event(spark, "Resistance"), slow).first().cancelled
    assert L.breakout_cancellation(event(spark, "Resistance"), slow, crossing=False).first().cancel_idx == 2


def test_late_retest_and_fade(spark):
    b = closes(spark, [111.0] * 400 + [105.0, 125.0])
    assert B.retest_entries(event(spark, "Support"), b).first().retest_idx == 400
    f = B.gravitation_fade(event(spark, "Gravitation", "activated"), b).first()
    assert (f.entry_idx, f.entry, f.side, f.tp) == (401, 125.0, "short", 105.0)


def test_every_alert_of_a_bar(spark):
    rows = [(*K, 0, False, False, False, False), (*K, 1, True, False, True, False), (*K, 2, True, False, False, False)]
    d = spark.createDataFrame(rows, "exchange string, symbol string, interval string, bar_idx long, trending_up boolean, trending_down boolean, long_setup boolean, short_setup boolean")
    assert sorted((r.bar_idx, r.alert) for r in G.regime_alerts(d).collect()) == [(1, "long_entry"), (1, "trending_up")]


def test_first_bar_where_takes_null_keys(spark):
    e = spark.createDataFrame([("a", None, 0), (None, None, 0)], "g string, h string, i long")
    b = spark.createDataFrame([("a", None, k, k == 200) for k in range(300)] + [(None, None, k, k == 3) for k in range(5)], "g string, h string, _bi long, hit boolean")
    got = {r.g: r._hit for r in J.first_bar_where(e, b, ["g", "h"], "i", F.col("hit")).collect()}
    assert got == {"a": 200, None: 3}


def test_quantiles_of_a_frequent_value(spark):
    d = spark.range(40_000).select(F.when(F.col("id") % 10 > 0, F.lit("a")).alias("g"), F.when(F.col("id") % 3 > 0, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    got = {r.g: (r.q25, r.q50, r.q99) for r in stats.exact_quantiles(d, ["g"], "v", [0.25, 0.5, 0.99], partitions=7).collect()}
    want = {r.g: tuple(r.q) for r in d.groupBy("g").agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.99))).alias("q")).collect()}
    assert got == want


def test_staged_exits(spark):
    """Stop first; break-even after the first target; all three parts."""
    rows = [(*K, "a", 0, "long", 100.0, 90.0, 110.0, 120.0), (*K, "b", 4, "long", 100.0, 90.0, 110.0, 120.0), (*K, "c", 7, "short", 100.0, 110.0, 90.0, 80.0)]
    t = spark.createDataFrame(rows, "exchange string, symbol string, interval string, trade_id string, entry_idx long, side string, entry double, stop double, tp1 double, tp2 double")
    b = closes(spark, [100.0, 105.0, 89.0, 100.0, 100.0, 111.0, 99.0, 100.0, 89.0, 79.0, 85.0, 91.0])
    got = {r.trade_id: (r.exit_kind_1, r.exit_kind_2, r.exit_kind_3, r.r_multiple) for r in B.staged_exits(t, b).collect()}
    assert got["a"] == ("stop", None, None, -1.0)
    assert got["b"] == ("tp", "stop", None, 0.5)
    assert got["c"][:3] == ("tp", "tp", "stop") and abs(got["c"][3] - (0.5 + 0.3 * 2 + 0.2)) < 1e-9


def expected_held(rows):
    """The chart's bar-by-bar rules: a candidate all the time, one held range."""
    out, held, run = [], None, []
    spans = [r[6] - r[7] for r in rows]
    for i, r in enumerate(rows):
        high, low, close, volume = r[6], r[7], r[8], r[9]
        run = run + [(i, high, low, volume)] if i >= 19 and spans[i] < 1.5 * sum(spans[i - 19:i + 1]) / 20 else []
        if held is None and 8 <= len(run) <= 100:
            vol = {1: [], -1: []}
            for k in range(1, len(run)):
                top, bottom = max(x[1] for x in run[:k + 1]), min(x[2] for x in run[:k + 1])
                if run[k][1] >= top - (top - bottom) * 0.1:
                    vol[1].append(run[k][3])
                if run[k][2] <= bottom + (top - bottom) * 0.1:
                    vol[-1].append(run[k][3])
            per = [sum(v) / len(v) if v else 0.0 for v in vol.values()]
            if max(per) > 0:
                pressure = (per[0] - per[1]) / max(per) * 100
                held = [run[0][0], i, max(x[1] for x in run), min(x[2] for x in run), "Resistance" if pressure > 10 else "Support" if pressure < -10 else "Gravitation"]
        if held is not None:
            _, _, top, bottom, kind = held
            back = kind == "Resistance" and low < top - (top - bottom) * 0.7 or kind == "Support" and high > bottom + (top - bottom) * 0.7
            if close > top or close < bottom or back:
                out.append((*held, i, "breakout_up" if close > top else "breakout_down" if close < bottom else "cancelled"))
                held = None
    return out + ([(*held, None, None)] if held else [])


def test_held_ranges_by_the_bar(spark, bars, tiny_blocks):
    rows = [tuple(r) for r in bars.orderBy("open_time").collect()]
    got = L.held_ranges(bars).select("range_start_idx", "confirm_idx", "range_high", "range_low", "range_type", "end_idx", "end_kind")
    want = expected_held(rows)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) >= 4
