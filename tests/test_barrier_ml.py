"""The classifier on splits without labelled rows or features."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.plans import barrier_ml as ML

H = 3_600_000
CFG = ML.MLConfig(train_end=100 * H, valid_end=200 * H, max_iter=2, max_depth=2, run_id="r")


def dataset(spark, rows):
    """rows: (hour, split, label, value of every feature)"""
    ddl = ("exchange string, symbol string, interval string, open_time long, entry_dt_utc long, entry_dt_syd long, split string, label int, "
           "dow_syd string, " + ", ".join(f"{c} double" for c in ML.FEATURES))
    return spark.createDataFrame([("X", "S", "1h", h * H, h * H, h * H, s, y, "Mon", *[v] * len(ML.FEATURES)) for h, s, y, v in rows], ddl)


@pytest.mark.parametrize("rows", [
    [(1, "train", None, 1.0), (2, "train", None, 2.0), (101, "valid", 1, 3.0), (102, "valid", 0, 4.0), (201, "test", 1, 5.0)], []])
def test_no_labelled_row_in_the_train_split(spark, rows):
    ds = dataset(spark, rows)
    model, metrics = ML.train(ds, CFG)
    m = metrics.first()
    assert model is None and m.n_train == 0 and m.n_valid == sum(r[1] == "valid" for r in rows)
    assert m.auc_train is None and m.auc_valid is None and m.auc_test is None
    assert ML.importances(model, spark).count() == 0
    assert ML.permutation_importance(model, ds, [], frac=1.0).count() == 0
    preds = ML.score(model, ds, CFG)
    assert [(r.p_win, r.take_trade) for r in preds.collect()] == [(None, 0)] * sum(r[2] is not None for r in rows)
    assert ML.latest_run(preds).collect()[0][0] == ("r" if rows else None)
    trades = spark.createDataFrame([("X", "S", "1h", 101 * H)], "exchange string, symbol string, interval string, entry_time_utc long")
    assert ML.ml_filter(trades, preds).count() == 0


def test_train_rows_without_any_feature_value(spark):
    ds = dataset(spark, [(h, "train", h % 2, None) for h in range(8)])
    model, metrics = ML.train(ds, replace(CFG, max_iter=1))
    assert metrics.first().n_train == 8
    assert ML.score(model, ds, CFG).where("p_win IS NOT NULL").count() == 8


@pytest.mark.parametrize("n", [1, 2, 3])
def test_fewer_train_rows_than_weekdays(spark, n):
    """The weekday has a value for each day and one for unseen days: more than there are training rows."""
    days = ["Mon", "Tue", "Wed"]
    ds = dataset(spark, [(h, "train", 1, float(h)) for h in range(n)] + [(101, "valid", 1, 3.0), (102, "valid", 0, 4.0), (201, "test", 1, 5.0)])
    day = F.when(F.col("split") == "test", "Sun").otherwise(F.element_at(F.array(*map(F.lit, days)), (F.col("open_time") / H).cast("int") % 3 + 1))
    ds = ds.withColumn("dow_syd", day)
    model, metrics = ML.train(ds, CFG)
    m = metrics.first()
    assert (m.n_train, m.n_valid, m.auc_train) == (n, 2, None) and m.auc_valid == 0.5
    assert {r.feature for r in ML.importances(model, spark).collect()} == {*ML.FEATURES, "dow_syd_idx"}
    assert ML.permutation_importance(model, ds, ["atrp"], frac=1.0).count() == 1
    preds = ML.score(model, ds, CFG)
    assert preds.where("p_win > 0.5 AND take_trade = 1").count() == n + 3  # only wins were seen
    trades = spark.createDataFrame([("X", "S", "1h", 101 * H)], "exchange string, symbol string, interval string, entry_time_utc long")
    assert ML.ml_filter(trades, preds).count() == 1
