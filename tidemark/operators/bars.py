"""Bars from ticks (T10) and coarser bars from finer ones.

Both are aggregates on (key, bucket): partial aggregation runs
map-side, so a hot symbol is spread over all its buckets and never needs
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import null_safe_join
from tidemark.schemas import INTERVAL_MS
from tidemark.session import cut_lineage

BROADCAST_BARS = 500_000  # bars whose ends are broadcast; more are joined by key


def bucket_start(ms_col: str, every_ms: int):
    c = F.col(ms_col)
    return c - F.pmod(c, F.lit(int(every_ms)))


def open_high_low_close(rows: DataFrame, key: Sequence[str], order: Sequence[str], price: str, size: str,
                        broadcast_bars: int = BROADCAST_BARS) -> DataFrame:
    """(key, open, high, low, close, volume): open and close are the prices of the first and last row by the columns ``order`` (NULL first).

    An extreme by several columns makes Spark sort all rows.  So a hash aggregate takes the ends of the first column of
    ``order``, and only rows at an end of their bar are compared by all columns."""
    key, first = list(key), F.col(order[0])
    ends = cut_lineage(rows.groupBy(*key).agg(
        F.when(F.count(first) == F.count(F.lit(1)), F.min(first)).alias("_lo"), F.max(first).alias("_hi"),
        F.max(price).alias("_high"), F.min(price).alias("_low"), F.sum(size).alias("_volume")))
    few = ends.limit(broadcast_bars + 1).count() <= broadcast_bars
    at_end = null_safe_join(rows, F.broadcast(ends) if few else ends, key).where(first.eqNullSafe(F.col("_lo")) | first.eqNullSafe(F.col("_hi")))
    by = F.struct(*order)
    return at_end.groupBy(*key).agg(F.min_by(price, by).alias("open"), F.max("_high").alias("high"), F.max("_low").alias("low"),
                                    F.max_by(price, by).alias("close"), F.max("_volume").alias("volume"))


def bars_from_ticks(ticks: DataFrame, every: str, ms: str = "ms", seq: str = "seq", price: str = "price",
                    size: str = "size") -> DataFrame:
    """Ticks (exchange, symbol, ms, seq, price, size) -> OHLCV bars.

    Open/close are the prices of the first/last tick by (ms, seq): a total
    order, so the result does not depend on partitioning.
    """
    every_ms = INTERVAL_MS[every]
    d = ticks.withColumn("open_time", bucket_start(ms, every_ms))
    return (open_high_low_close(d, ["exchange", "symbol", "open_time"], [ms, seq], price, size)
            .select("exchange", "symbol", F.lit(every).alias("interval"), "open_time",
                    (F.col("open_time") + F.lit(every_ms - 1)).alias("close_time"),
                    "open", "high", "low", "close", "volume"))


def resample_bars(bars: DataFrame, to: str) -> DataFrame:
    """Aggregate bars into ``to`` buckets (higher-timeframe request).

    Output bars keep the input's key with ``interval = to``; bars of different
    source intervals are never added up (``source_interval``).  A bucket's open
    is the first bar's open, close the last bar's close.
    """
    to_ms = INTERVAL_MS[to]
    first = F.struct("open_time", "open")
    last = F.struct("open_time", "close")
    return (bars.withColumn("_b", bucket_start("open_time", to_ms))
            .groupBy("exchange", "symbol", F.col("interval").alias("source_interval"), "_b")
            .agg(F.min_by("open", first).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
                 F.max_by("close", last).alias("close"), F.sum("volume").alias("volume"),
                 F.count(F.lit(1)).alias("n_bars"))
            .select("exchange", "symbol", F.lit(to).alias("interval"), F.col("_b").alias("open_time"),
                    (F.col("_b") + F.lit(to_ms - 1)).alias("close_time"),
                    "open", "high", "low", "close", "volume", "n_bars", "source_interval"))
