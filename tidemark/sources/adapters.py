"""Domain tables derived from the driver's test tables.

The reference reads ready-made bars, alerts, plans and JSON snapshots; the
test data has TPC-H tables and an ``events`` tick stream.  Each adapter is a
plain aggregation/projection, so its cost grows with the input tables.  The
same derivations are written in SQL in ``tidemark.catalog.sqlsrc`` for the
DuckDB oracle; keep the two in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timeutil import ntz_to_ms
from tidemark.operators.bars import bars_from_ticks, open_high_low_close
from tidemark.schemas import INTERVAL_MS

EVT_EXCHANGE = "EVT"
TPCH_EXCHANGE = "TPCH"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> ticks: (exchange, symbol, ms, seq, price, size)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.lit(EVT_EXCHANGE).alias("exchange"), F.col("event_type").alias("symbol"),
                     ntz_to_ms("ts").alias("ms"), F.col("event_id").alias("seq"),
                     F.col("value").alias("price"), F.lit(1.0).alias("size"))


def bars_events(spark: SparkSession, sf_dir: str, every: str = "1h") -> DataFrame:
    """Bars of ``every`` from the events ticks (volume = tick count)."""
    return bars_from_ticks(ticks(spark, sf_dir), every)


def bars_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per l_returnflag from lineitem (volume = sum of quantity)."""
    li = table(spark, sf_dir, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    day = INTERVAL_MS["1d"]
    rows = li.select(F.col("l_returnflag").alias("symbol"), ntz_to_ms("l_shipdate").alias("open_time"), "l_quantity", *order)
    return (open_high_low_close(rows, ["symbol", "open_time"], order, "l_extendedprice", "l_quantity")
            .select(F.lit(TPCH_EXCHANGE).alias("exchange"), "symbol", F.lit("1d").alias("interval"),
                    "open_time", (F.col("open_time") + F.lit(day - 1)).alias("close_time"),
                    "open", "high", "low", "close", "volume"))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert per event; side by user parity, timeframe by user_id mod 4."""
    return alerts_from_events(table(spark, sf_dir, "events"))


def alerts_from_events(ev: DataFrame) -> DataFrame:
    """The alert projection of an events frame (batch or stream)."""
    u = F.col("user_id")
    return ev.select(
        F.col("event_id").alias("id"), ntz_to_ms("ts").alias("ts"), ntz_to_ms("ts").alias("created_ts"),
        F.lit(EVT_EXCHANGE).alias("exchange"), F.col("event_type").alias("symbol"),
        F.when(F.pmod(u, F.lit(2)) == 0, "BUY").otherwise("SELL").alias("signal"),
        F.when(F.pmod(u, F.lit(4)) < 2, "15m").otherwise("1h").alias("source_tf"),
        F.col("value").alias("price"), F.col("event_type").alias("reason"),
        (F.pmod(u, F.lit(10)) / F.lit(10.0)).alias("setup_score"),
        F.when(F.pmod(u, F.lit(10)) >= 7, "A").when(F.pmod(u, F.lit(10)) >= 4, "B").otherwise("C").alias("setup_grade"),
        F.lit(None).cast("string").alias("avoid_reasons"), F.col("props").alias("metrics_json"))


def trade_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One plan per alert, risk 2% of price; defects injected by id residues
    (missing stop, stop on the wrong side, outlier multiplier, bad risk)."""
    a = alerts(spark, sf_dir)
    i = F.col("id")
    e = F.col("price")
    risk = e * F.lit(0.02) + F.lit(0.01)
    sgn = F.when(F.col("signal") == "BUY", F.lit(1.0)).otherwise(F.lit(-1.0))
    flip = F.when(F.pmod(i, F.lit(47)) == 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    stop = F.when(F.pmod(i, F.lit(53)) == 0, F.lit(None).cast("double")).otherwise(e - sgn * flip * risk)
    return a.select(
        i.alias("id"), i.alias("alert_id"), "ts", "exchange", "symbol", F.col("signal").alias("side"),
        F.when(F.pmod(i, F.lit(3)) == 0, "limit").otherwise("market").alias("entry_type"),
        e.alias("entry_price"), stop.alias("stop_loss"),
        (e + sgn * F.lit(1.5) * risk).alias("tp1"), (e + sgn * F.lit(3.0) * risk).alias("tp2"),
        F.when(F.pmod(i, F.lit(7)) == 0, F.lit(None).cast("double")).otherwise(e + sgn * F.lit(4.5) * risk).alias("tp3"),
        (risk / F.lit(1.5)).alias("atr"),
        F.when(F.pmod(i, F.lit(101)) == 0, F.lit(60.0)).otherwise(F.lit(1.5)).alias("atr_mult"),
        F.when(F.pmod(i, F.lit(3)) == 0, "swing_low").when(F.pmod(i, F.lit(3)) == 1, "swing_high")
         .otherwise("none").alias("swing_ref"),
        F.when(F.pmod(i, F.lit(61)) == 0, F.abs(e - stop) * F.lit(3.0)).otherwise(F.abs(e - stop)).alias("risk_per_unit"),
        F.lit(1.5).alias("rr_tp1"), F.lit(3.0).alias("rr_tp2"),
        F.when(F.pmod(i, F.lit(59)) == 0, F.lit(75.0)).otherwise(F.lit(4.5)).alias("rr_tp3"),
        F.col("metrics_json").alias("plan_json"))


SNAP_ROWS = 50          # customers per snapshot (bounded document size)
SNAP_T0 = 1_704_067_200_000


def snapshot_rows_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat snapshot rows from customer (the truth the JSON must reproduce)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    sid = F.floor(k / F.lit(SNAP_ROWS)).cast("long")
    bal = F.col("c_acctbal")
    return c.select(
        sid.alias("snapshot_id"),
        F.when(F.pmod(sid, F.lit(2)) == 0, "binance").otherwise("bybit").alias("snap_exchange"),
        (F.lit(SNAP_T0) + sid * F.lit(3_600_000)).alias("snap_ts"),
        F.col("c_name").alias("symbol"), F.col("c_mktsegment").alias("exchange"),
        bal.alias("last_price"),
        F.when(bal > 0, bal * F.lit(1_000_000.0)).alias("market_cap"),
        (F.pmod(k, F.lit(300)) + 1).alias("liquidity_rank"),
        (F.pmod(k, F.lit(300)) < 200).alias("liquidity_top200"),
        F.when(F.pmod(F.col("c_nationkey"), F.lit(3)) == 0, "strong")
         .when(F.pmod(F.col("c_nationkey"), F.lit(3)) == 1, "moderate").otherwise("weak").alias("signal_strength"),
        F.when(bal >= 0, "bullish").otherwise("bearish").alias("mtf_summary"),
        F.array(F.lower("c_mktsegment"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("sector_tags"),
        ((F.pmod(k, F.lit(200)) - F.lit(100)) / F.lit(10.0)).alias("change_60m"),
        ((F.pmod(k, F.lit(40)) - F.lit(20)) / F.lit(10.0)).alias("change_15m"),
        F.abs(bal).alias("vol_1m"),
        F.pmod(k, F.lit(100)).cast("double").alias("rsi_14"),
        (F.pmod(k, F.lit(21)) - F.lit(10)).cast("double").alias("momentum_score"),
        (k * F.lit(10)).cast("double").alias("open_interest"),
        (bal / F.lit(1_000_000.0)).alias("funding_rate"),
    )


def snapshot_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """snapshot_cache rows: one JSON document per group of SNAP_ROWS customers,
    under rotating wrappers (bare array, data, data.items, unknown key, broken)."""
    r = snapshot_rows_source(spark, sf_dir)
    body_cols = [c for c in r.columns if c not in ("snapshot_id", "snap_exchange", "snap_ts")]
    docs = (r.groupBy("snapshot_id", "snap_exchange", "snap_ts")
            .agg(F.to_json(F.collect_list(F.struct(*body_cols))).alias("_arr")))
    m = F.pmod(F.col("snapshot_id"), F.lit(5))
    arr = F.col("_arr")
    doc = (F.when(m == 0, arr)
           .when(m == 1, F.concat(F.lit('{"data":'), arr, F.lit("}")))
           .when(m == 2, F.concat(F.lit('{"meta":{"n":1},"data":{"items":'), arr, F.lit("}}")))
           .when(m == 3, F.concat(F.lit('{"meta":{"n":1},"zzz":'), arr, F.lit("}")))
           .otherwise(F.concat(F.lit('{bad'), arr)))
    return docs.select(F.col("snapshot_id").alias("id"), F.col("snap_exchange").alias("exchange"),
                       F.col("snap_ts").alias("ts"), doc.alias("snapshot_json"))


def market_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_acctbal") > 0).select(
        F.col("c_name").alias("symbol"), (F.lit(SNAP_T0) + F.col("c_custkey")).alias("ts"),
        (F.col("c_acctbal") * F.lit(1_000_000.0)).alias("market_cap"))
