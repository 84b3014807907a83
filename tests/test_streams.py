"""Streams of bars that come out of order give the events of the ordered bars, up to the last watermark."""

import random

from pyspark.sql import functions as F

from tests.conftest import SF01
from tidemark.catalog import q_stream
from tidemark.catalog.common import bars_all
from tidemark.operators import ranges as L
from tidemark.streaming import streams as ST

EV = ["exchange", "symbol", "interval", "bar_idx", "event", "range_start_idx", "range_type", "vol_degree", "open_time"]
SCHEMA = "exchange string, symbol string, interval string, open_time long, open double, high double, low double, close double, volume double"


def test_shuffled_range_events_equal_batch(spark):
    bars = bars_all(spark, SF01)
    last = bars.agg(F.max("open_time")).first()[0] - q_stream.DELAY_MS
    batch = L.live_ranges(bars, L.RangeTracker(cancellations=True)).where(F.col("open_time") <= last)
    rows = lambda df: sorted(tuple(r) for r in df.select(*EV).collect())
    got = rows(q_stream.st3_shuffled_range_events(spark, SF01))
    assert got and got == rows(batch)


def _bars(n, seed):
    rng, rows = random.Random(seed), []
    for symbol in ("A", None):
        price = 100.0
        for i in range(n):
            o, price = price, price + rng.uniform(-1, 1) + (0.4 if i // 60 % 2 else -0.4)
            rows.append(("X", symbol, "1h", (i + 1) * 3_600_000, o, max(o, price) + 0.1, min(o, price) - 0.1, price, 1.0))
    return rows


def _run(spark, files, watermark):
    src, out, ck = (ST.scratch(spark, n) for n in ("t-src", "t-out", "t-ck"))
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    ST.run_available(ST.stream_regime_alerts(stream, watermark), out, ck)
    return sorted((r.symbol or "", r.open_time, r.alert) for r in spark.read.parquet(out).collect())


def test_order_of_arrival_does_not_matter(spark):
    rows = _bars(300, 4)
    whole = _run(spark, [rows], None)
    mark = (300 - 100) * 3_600_000
    want = [r for r in whole if r[1] <= mark]
    assert want and {r[0] for r in want} == {"", "A"} and len(want) < len(whole)
    late = sorted(rows, key=lambda r: (r[3] + random.Random(f"{r[1]}{r[3]}").randrange(95) * 3_600_000))
    files = [late[i:i + 150] for i in range(0, 600, 150)]
    assert _run(spark, files, "100 hours") == want
    # a repeated bar is reported once its time has come, whichever copy comes first; one behind the watermark, without a time or price is dropped
    odd = [("X", "A", "1h", 201 * 3_600_000, 1.0, 1.0, 1.0, 1.0, 1.0)]
    bad = [("X", "A", "1h", None, 1.0, 1.0, 1.0, 1.0, 1.0), ("X", "A", "1h", 3_600_000 * 250, None, 1.0, 1.0, 1.0, 1.0)]
    got = _run(spark, [files[0] + [rows[150]], files[1] + bad, files[2], files[3] + [rows[0]]], "100 hours")
    assert got == sorted(want + [("A", 151 * 3_600_000, "late_bar")])
    assert [r for r in _run(spark, [rows[:200], odd + rows[200:300], rows[300:]], None) if r[2] == "late_bar"] == [("A", 201 * 3_600_000, "late_bar")]
