"""First touch by the tree of extremes against plain loops; NULL series keys through every helper that joins on them."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.operators import joins as J
from tidemark.operators import outcomes as B
from tidemark.operators import ranges as L
from tidemark.operators import touch
from tidemark.operators.statemachine import Machine, block_scan

KEYS = "exchange string, symbol string, interval string"


def made(seed: int, sizes: dict) -> dict:
    rng = random.Random(seed)
    out = {}
    for key, n in sizes.items():
        mid, bars = 100.0, []
        for _ in range(n):
            mid += rng.gauss(0, 1)
            bars.append((round(mid + rng.random(), 2), round(mid - rng.random(), 2)))
        out[key] = bars
    return out


@pytest.mark.parametrize("fanout,strict", [(2, False), (3, True), (32, False)])
def test_first_touch_against_loops(spark, fanout, strict):
    series = made(fanout, {("a", None, "1h"): 700, (None, None, None): 130, ("b", "s", "1d"): 1})
    series["a", None, "1h"][5] = (None, float("nan"))
    rng = random.Random(1)
    bars = spark.createDataFrame([(*k, i, h, lo) for k, v in series.items() for i, (h, lo) in enumerate(v)], f"{KEYS}, bar_idx long, high double, low double")
    entries = []
    for n in range(400):
        k = rng.choice([*series, ("c", "none", "1h")])
        level = 100 + rng.gauss(0, 25)
        up, down = rng.choice([(level, None), (None, level), (level + 20, level - 20), (None, None), (1e9, -1e9)])
        entries.append((*k, n, rng.randrange(-2, 750), up, down))
    df = spark.createDataFrame(entries, f"{KEYS}, n long, s long, u double, d double")
    got = {r.n: (r._hit, r._hit_high, r._hit_low) for r in touch.first_touch(df, bars, ["exchange", "symbol", "interval"], "s", F.col("u"), F.col("d"), strict=strict, fanout=fanout).collect()}
    assert len(got) == 400
    for *k, n, s, up, down in entries:
        want = (None, None, None)
        for i, (h, lo) in enumerate(series.get(tuple(k), [])):
            above = up is not None and h is not None and (h > up if strict else h >= up)
            below = down is not None and lo is not None and (lo < down if strict else lo <= down)
            if i >= s and (above or below):
                want = (i, h, lo)
                break
        assert got[n] == want, (k, n)


def test_first_touch_of_nothing(spark):
    bars = spark.createDataFrame([], f"{KEYS}, bar_idx long, high double, low double")
    e = spark.createDataFrame([("a", "b", "1h", 0, 1.0)], f"{KEYS}, s long, u double")
    assert [r._hit for r in touch.first_touch(e, bars, ["exchange", "symbol", "interval"], "s", F.col("u"), None).collect()] == [None]
    assert touch.first_touch(e.limit(0), bars, ["exchange", "symbol", "interval"], "s", F.col("u"), None).count() == 0


# ------------------------------------------------------------------ NULL keys

def counter() -> Machine:
    """Counts rows for ever, so that no block can be verified by its halo."""
    class Count(Machine):  # local: goes to the workers by value
        event_fields = (("n", LongType()),)

        def initial(self):
            return {"n": 0}

        def step(self, state, row):
            state["n"] += 1
            return [{"n": state["n"]}] if row["v"] else []

    return Count()


def test_machines_end_under_null_keys(spark, tiny_blocks):
    rows = [(k, None, "1h", i, i % 50 == 0) for k in (None, "a") for i in range(300)]
    df = spark.createDataFrame(rows, f"{KEYS}, bar_idx long, v boolean")
    got = sorted((str(r.exchange), r.bar_idx, r.n) for r in block_scan(df, counter(), ["v"], halo=8).collect())
    assert got == sorted((str(k), i, i + 1) for k in (None, "a") for i in range(0, 300, 50))


def test_nth_previous_and_selection_under_null_keys(spark, tiny_blocks):
    df = spark.createDataFrame([(None, i, i % 3 == 0, float(i)) for i in range(300)], "k string, bar_idx long, up boolean, v double")
    got = {r.bar_idx: r.prev2_v for r in J.nth_previous(df, "up", ["v"], 2, ["k"]).collect()}
    assert got == {i: (float((i - 1) // 3 * 3 - 3) if i > 3 else None) for i in range(300)}
    t = spark.createDataFrame([(None, i, i + 3, f"{i:03}") for i in range(200)], "k string, s long, e long, id string")
    kept = sorted(r.s for r in B.non_overlapping(t, ["k"], "s", "e", ["s", "id"], span=64).collect())
    assert kept == list(range(0, 200, 4))


def test_windows_and_ranges_under_null_keys(spark, tiny_blocks):
    left = spark.createDataFrame([(None, 10, 25)], "k string, lo long, hi long")
    right = spark.createDataFrame([(None, t) for t in range(0, 40, 5)], "k string, t long")
    assert sorted(r.t for r in J.within_time_window(left, right, ["k"], "lo", "hi", "t", 15).collect()) == [10, 15, 20, 25]
    rng = random.Random(2)
    rows = []
    for key in (None, "a"):
        rng.seed(2)
        price = 100.0
        for i in range(400):
            price += rng.gauss(0, 0.3 if i % 100 < 70 else 4)
            rows.append((key, None, "1h", i * 3_600_000, i * 3_600_000 + 1, price, price + rng.random(), price - rng.random(), price + rng.gauss(0, 0.2), 10.0 + rng.random()))
    bars = spark.createDataFrame(rows, f"{KEYS}, open_time long, close_time long, open double, high double, low double, close double, volume double")
    for out in (L.fixed_ranges(bars, max_bars=20).select("exchange", "start_idx", "range_high", "imbalance"),
                L.simple_imbalance(bars).select("exchange", "bar_idx", "cons_high", "simple_imbalance"),
                L.live_ranges(bars).select("exchange", "bar_idx", "event", "range_high")):
        got = out.collect()
        halves = [sorted(map(str, (r[1:] for r in got if r[0] == k))) for k in (None, "a")]
        assert halves[0] == halves[1] and halves[0]


def test_hot_buckets_are_split(spark):
    left = spark.createDataFrame([(k, n, t, t + 40) for k in (None, "a") for n, t in enumerate(range(0, 400, 30))], "k string, n long, lo long, hi long")
    right = spark.createDataFrame([(k, t % 400, t) for k in (None, "a", "b") for t in range(900)], "k string, t long, v long")
    plain = sorted(map(repr, J.within_time_window(left, right, ["k"], "lo", "hi", "t", 40).collect()))
    rows = sorted(map(repr, J.within_rows(left, right, ["k"], "n", 0, 15, right_idx="t").collect()))
    spark.conf.set(J.HEAVY_ROWS_CONF, "7")
    try:
        assert sorted(map(repr, J.within_time_window(left, right, ["k"], "lo", "hi", "t", 40).collect())) == plain and plain
        assert sorted(map(repr, J.within_rows(left, right, ["k"], "n", 0, 15, right_idx="t").collect())) == rows and rows
    finally:
        spark.conf.unset(J.HEAVY_ROWS_CONF)


def test_dense_series_are_cut(spark, tiny_blocks):
    from tidemark.operators import series

    ticks = spark.createDataFrame([("a", 1_000 * (i // 40), i) for i in range(4000)] + [(None, 10 ** 9 * i, i) for i in range(300)], "k string, t long, v long")
    d = series.density_blocks(ticks, ["k"], "t", 1_000)
    sizes = {(r.k, r._cb): r["count"] for r in d.groupBy("k", "_cb").count().collect()}
    assert max(sizes.values()) <= 64 + 40 and len(sizes) > 50
    left = spark.createDataFrame([(k, t, i) for k in ("a", None) for i, t in enumerate(range(-500, 120_000, 777))], "k string, t long, n long")
    got = {(r.k, r.n): (r.r_t, r.r_v) for r in J.asof_backward(left, ticks.select("k", "t", "v"), "t", ["k"], ["v"], grain=1_000).collect()}
    for r in left.collect():
        own = [(t, v) for k, t, v in [("a", 1_000 * (i // 40), i) for i in range(4000)] + [(None, 10 ** 9 * i, i) for i in range(300)] if k == r.k and t <= r.t]
        assert got[r.k, r.n] == (max(own) if own else (None, None))
