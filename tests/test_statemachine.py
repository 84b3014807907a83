"""Block-verified state machines: any block size / halo gives the same
events as one uninterrupted run, and the stream equals the batch."""

from tests.conftest import SF01
from tidemark.catalog import q_stream
from tidemark.catalog.common import bars_all
from tidemark.operators import outcomes as B
from tidemark.operators import ranges as L

EV = ["exchange", "symbol", "interval", "bar_idx", "event", "range_start_idx", "range_type", "vol_degree"]


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_live_ranges_block_invariant(spark):
    whole = _rows(L.live_ranges(bars_all(spark, SF01)), EV)
    spark.conf.set("tidemark.series.blockRows", "128")
    try:
        short_halo = _rows(L.live_ranges(bars_all(spark, SF01), halo=8), EV)  # forces exact reruns
        long_halo = _rows(L.live_ranges(bars_all(spark, SF01), halo=128), EV)
    finally:
        spark.conf.unset("tidemark.series.blockRows")
    assert whole and whole == short_halo == long_halo


def test_stream_equals_batch(spark):
    batch = _rows(L.live_ranges(bars_all(spark, SF01), L.RangeTracker(cancellations=True)), EV)
    assert any(r[4] == "cancelled" for r in batch)
    stream = _rows(q_stream.st3_stream_range_events(spark, SF01), EV)
    assert batch == stream


def test_non_overlapping_block_invariant(spark):
    """Greedy selection equals a plain Python loop, also with tiny blocks and
    a short halo (forcing exact re-runs)."""
    import random
    rnd = random.Random(7)
    rows = []
    for k in ("a", "b"):
        t = 0
        for i in range(400):
            t += rnd.randint(0, 5)
            rows.append((k, i, t, t + rnd.randint(0, 12)))
    df = spark.createDataFrame(rows, "g string, tid long, s long, e long")
    expect = []
    for k in ("a", "b"):
        last = None
        for _, tid, s, e in sorted((r for r in rows if r[0] == k), key=lambda r: (r[2], r[3], r[1])):
            if last is None or s > last:
                expect.append((k, tid))
                last = e
    spark.conf.set("tidemark.series.blockRows", "32")
    try:
        got = B.non_overlapping(df, ["g"], "s", "e", ["s", "e", "tid"], span=64)
        got = sorted((r.g, r.tid) for r in got.select("g", "tid").collect())
    finally:
        spark.conf.unset("tidemark.series.blockRows")
    assert got == sorted(expect)
