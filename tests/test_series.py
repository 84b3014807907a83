"""Skew-safe series layer: blocked results equal whole-key results."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF01
from tidemark.catalog.common import bars_all
from tidemark.operators import series
from tidemark.operators import windows as W

K = ["exchange", "symbol", "interval"]


def _plain(bars):
    w = Window.partitionBy(*K).orderBy("open_time")
    return bars.withColumn("bar_idx", F.row_number().over(w) - 1)


def test_index_matches_row_number(spark, tiny_blocks):
    b = bars_all(spark, SF01)
    a = series.index_series(b).select(*K, "open_time", "bar_idx")
    e = _plain(b).select(*K, "open_time", "bar_idx")
    assert a.exceptAll(e).count() == 0 and e.exceptAll(a).count() == 0


def test_halo_windows_equal_whole_key_windows(spark, tiny_blocks):
    b = series.index_series(bars_all(spark, SF01))

    def build(w):
        return {"s": W.sma("close", w, 20), "lag3": F.lag("close", 3).over(w), "lead5": F.lead("close", 5).over(w),
                "mx": F.max("high").over(W.prior(w, 10))}

    got = series.halo_windows(b, build, back=20, fwd=5).select(*K, "bar_idx", "s", "lag3", "lead5", "mx")
    w = Window.partitionBy(*K).orderBy("bar_idx")
    exp = b.select(*K, "bar_idx", *[v.alias(k) for k, v in build(w).items()])
    r = got.join(exp.select(*K, "bar_idx", *[F.col(c).alias("e_" + c) for c in ("s", "lag3", "lead5", "mx")]),
                 [*K, "bar_idx"])
    for c in ("s", "lag3", "lead5", "mx"):
        bad = r.where(~F.col(c).eqNullSafe(F.col("e_" + c)) & ~(F.abs(F.col(c) - F.col("e_" + c)) < 1e-9))
        assert bad.count() == 0, c


def test_ewm_equals_pandas(spark, tiny_blocks):
    b = series.index_series(bars_all(spark, SF01)).where("interval = '1h'")
    got = series.ewm(b, [("close", 2 / 21, "e20")]).select(*K, "bar_idx", "close", "e20").toPandas()
    for _, g in got.groupby(K):
        g = g.sort_values("bar_idx")
        exp = g["close"].ewm(span=20, adjust=False).mean().to_numpy()
        assert np.allclose(g["e20"].to_numpy(), exp, rtol=1e-10, atol=1e-9)


def test_ewm_null_holds_value(spark):
    df = spark.createDataFrame(pd.DataFrame({"exchange": "X", "symbol": "S", "interval": "1h",
                                             "bar_idx": range(6), "x": [None, 1.0, 2.0, None, 4.0, 5.0]}))
    out = series.ewm(df, [("x", 0.5, "e")]).orderBy("bar_idx").toPandas()["e"].tolist()
    exp = pd.Series([None, 1.0, 2.0, None, 4.0, 5.0], dtype="float64").ewm(alpha=0.5, adjust=False,
                                                                         ignore_na=True).mean().tolist()
    assert out[0] is None or out[0] != out[0]
    assert np.allclose(out[1:], exp[1:])
