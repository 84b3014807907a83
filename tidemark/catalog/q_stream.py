"""Registered queries: Structured Streaming (ST1-ST5).  Each runs a
streaming query over the test tables to completion (``availableNow``) into
a sink under the checkpoint folder and returns the sink's rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import sqlsrc
from tidemark.catalog.common import bars_all, prep
from tidemark.sources import adapters as A
from tidemark.streaming import streams as ST

QUERIES, SQL = {}, {}


def st1_stream_bars(spark, sf):
    prep(spark)
    out, ck = ST.scratch(spark, "bars-out"), ST.scratch(spark, "bars-ckpt")
    ST.run_available(ST.stream_bars(ST.event_ticks_stream(spark, sf), "1h", "10 minutes"), out, ck)
    return spark.read.parquet(out)


def st2_stream_dedup_alerts(spark, sf):
    prep(spark)
    ev = ST.table_stream(spark, sf, "events")
    out, ck = ST.scratch(spark, "dedup-out"), ST.scratch(spark, "dedup-ckpt")
    ST.run_available(ST.stream_dedup_alerts(A.alerts_from_events(ev)), out, ck)
    return spark.read.parquet(out).select("id", "exchange", "symbol", "signal", "source_tf", "ts")


def _bars_stream(spark, sf):
    src = ST.scratch(spark, "bars-src")
    b = bars_all(spark, sf)
    b.write.parquet(src)
    return spark.readStream.schema(b.schema).parquet(src)


DELAY_MS = 3 * 86_400_000
FILE_BARS = 500_000


def _shuffled_stream(spark, sf):
    """The bars as files that come out of order: a bar is up to DELAY_MS late, by a hash; one file a micro-batch."""
    b = bars_all(spark, sf).withColumn("_at", F.expr(f"open_time + pmod(xxhash64(exchange, symbol, interval, open_time), {DELAY_MS}L)"))
    whole = ST.scratch(spark, "bars-late")
    b.write.parquet(whole)
    late, src = spark.read.parquet(whole), ST.scratch(spark, "bars-shuffled")
    files = max(5, -(-late.count() // FILE_BARS))
    cuts = [None, *sorted(set(late.approxQuantile("_at", [i / files for i in range(1, files)], 0.01))), None]
    for lo, hi in zip(cuts, cuts[1:]):  # one file after another, as a file source goes by the files' times
        some = late if lo is None else late.where(F.col("_at") >= lo)
        some = some if hi is None else some.where(F.col("_at") < hi)
        some.drop("_at").coalesce(1).write.mode("append").parquet(src)
    return spark.readStream.schema(late.drop("_at").schema).option("maxFilesPerTrigger", 1).parquet(src)


def st3_shuffled_range_events(spark, sf):
    """The range events of bars that come out of order, up to the last watermark."""
    prep(spark)
    out, ck = ST.scratch(spark, "ranges-out"), ST.scratch(spark, "ranges-ckpt")
    ST.run_available(ST.stream_range_events(_shuffled_stream(spark, sf), watermark=f"{DELAY_MS} milliseconds"), out, ck)
    return spark.read.parquet(out)


def st4_shuffled_regime_alerts(spark, sf):
    """The regime alerts of bars that come out of order, up to the last watermark."""
    prep(spark)
    out, ck = ST.scratch(spark, "regime-out"), ST.scratch(spark, "regime-ckpt")
    ST.run_available(ST.stream_regime_alerts(_shuffled_stream(spark, sf), watermark=f"{DELAY_MS} milliseconds"), out, ck)
    return spark.read.parquet(out)


def st3_stream_range_events(spark, sf):
    prep(spark)
    out, ck = ST.scratch(spark, "ranges-out"), ST.scratch(spark, "ranges-ckpt")
    ST.run_available(ST.stream_range_events(_bars_stream(spark, sf)), out, ck)
    return spark.read.parquet(out)


def st4_stream_regime_alerts(spark, sf):
    prep(spark)
    out, ck = ST.scratch(spark, "regime-out"), ST.scratch(spark, "regime-ckpt")
    ST.run_available(ST.stream_regime_alerts(_bars_stream(spark, sf)), out, ck)
    return spark.read.parquet(out)


def st5_ingest_files(spark, sf):
    """Two availableNow runs over the same folder: the second loads nothing."""
    prep(spark)
    schema = spark.read.parquet(f"{sf}/orders.parquet").schema
    dest, ck = ST.scratch(spark, "ingest-dest"), ST.scratch(spark, "ingest-ckpt")
    ST.ingest_new_files(spark, sf, schema, dest, ck, glob="orders.parquet")
    ST.ingest_new_files(spark, sf, schema, dest, ck, glob="orders.parquet")
    return spark.read.parquet(dest).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


SQL["st5_ingest_files"] = "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1"

for _n, _f in list(globals().items()):
    if callable(_f) and _n.startswith("st") and _n[2:3].isdigit():
        QUERIES[_n] = _f


# Emitted bars: windows whose end is at or before the final watermark
# (max event time - 10 minutes); ticks ordered by (ts, event_id).
SQL["st1_stream_bars"] = """
WITH wm AS (SELECT epoch_us(max(ts)) - 600000000 AS w FROM events)
SELECT 'EVT' AS exchange, event_type AS symbol, '1h' AS interval,
       (epoch_us(ts) // 3600000000) * 3600000 AS open_time,
       (epoch_us(ts) // 3600000000) * 3600000 + 3599999 AS close_time,
       first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
       last(value ORDER BY ts, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume
FROM events, wm
GROUP BY 1, 2, 3, 4, 5, wm.w
HAVING ((epoch_us(any_value(ts)) // 3600000000) + 1) * 3600000000 <= wm.w"""


def _st4_sql():
    from tidemark.catalog.q_indicators import SQL as ISQL
    return ISQL["g5_regime_alerts"]


SQL["st4_stream_regime_alerts"] = _st4_sql()
# Alerts of bars at or before the final watermark (newest bar - DELAY_MS).
SQL["st4_shuffled_regime_alerts"] = f"""SELECT * FROM ({_st4_sql()}) a
WHERE open_time <= (SELECT max(open_time) - {DELAY_MS} FROM ({sqlsrc.bars_all()}) b)"""


# First alerts of the hours that end at or before the final watermark (max event time - 2 hours).
SQL["st2_stream_dedup_alerts"] = f"""WITH a AS (SELECT * FROM ({sqlsrc.alerts()})),
wm AS (SELECT max(ts) - 7200000 AS w FROM a),
r AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, signal, source_tf, ts // 3600000 ORDER BY ts, id) AS rn FROM a)
SELECT id, exchange, symbol, signal, source_tf, ts FROM r, wm WHERE rn = 1 AND (ts // 3600000 + 1) * 3600000 <= w"""
