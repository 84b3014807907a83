"""Bars whose open and close are extremes by several columns."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.bars import bars_from_ticks, open_high_low_close
from tidemark.sources import adapters as A


def test_open_and_close_with_null_and_repeated_orders(spark):
    rows = [("a", 1, 5, 2, 1.0, 1.0), ("a", 1, 5, 1, 2.0, 1.0), ("a", 1, None, 9, 3.0, 1.0), ("a", 1, 7, 1, None, 1.0), ("a", 1, 7, 0, 9.0, None),  # a NULL order, a NULL price
            ("a", 2, None, 4, 1.5, 2.0), ("a", 2, None, None, 2.5, 2.0),  # no order but in the second column
            (None, 1, 3, 3, 4.0, 1.0), (None, 1, 3, 3, 4.0, 1.0), (None, None, 1, 1, 8.0, 0.0), (None, None, 2, 1, 7.0, 0.0),  # NULL keys, a repeated row
            ("b", None, 1, 1, None, None)]
    d = spark.createDataFrame(rows, "k string, t long, o long, p long, price double, size double")
    by = F.struct("o", "p")
    plain = d.groupBy("k", "t").agg(F.min_by("price", by), F.max("price"), F.min("price"), F.max_by("price", by), F.sum("size"))
    expected = sorted(map(repr, map(tuple, plain.collect())))
    for broadcast_bars in (100, 0):
        got = open_high_low_close(d, ["k", "t"], ["o", "p"], "price", "size", broadcast_bars)
        assert got.columns == ["k", "t", "open", "high", "low", "close", "volume"]
        assert sorted(map(repr, map(tuple, got.collect()))) == expected


@pytest.mark.parametrize("kind", ["ticks", "lineitem"])
def test_only_the_ends_of_bars_are_compared_by_all_columns(spark, tmp_path, kind):
    """Rows between a bar's ends never reach the aggregate that sorts its input."""
    if kind == "ticks":
        ticks = spark.range(4000).select(F.lit("X").alias("exchange"), F.lit("S").alias("symbol"), (F.col("id") * 3_600).alias("ms"), F.col("id").alias("seq"),
                                         F.col("id").cast("double").alias("price"), F.lit(1.0).alias("size"))
        bars = bars_from_ticks(ticks, "1h")
    else:
        spark.range(4000).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(1).cast("long").alias("l_partkey"), F.lit(1).cast("long").alias("l_suppkey"),
                                 F.col("id").cast("double").alias("l_extendedprice"), F.lit(1.0).alias("l_quantity"), F.lit("N").alias("l_returnflag"),
                                 F.expr("timestamp_ntz'1996-01-01 00:00:00'").alias("l_shipdate")
                                 ).write.parquet(f"{tmp_path}/lineitem.parquet")
        bars = A.bars_lineitem(spark, str(tmp_path))
    plan = bars._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("SortAggregate"):] if "SortAggregate" in plan else plan
    assert "_lo" in below and "Join" in below, plan
    b = bars.orderBy("open_time").collect()
    assert b[0]["open"] == b[0]["low"] == 0.0 and b[-1]["close"] == b[-1]["high"] == 3999.0 and sum(r.volume for r in b) == 4000
