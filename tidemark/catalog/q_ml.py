"""Registered queries: ML barrier pipeline (E2, M1-M10).  Rows-only checks:
model training has no SQL statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.common import bars_all, listing, prep
from tidemark.session import cut_lineage
from tidemark.operators import outcomes as B
from tidemark.operators import signals as G
from tidemark.plans import barrier_ml as ML
from tidemark.sources import adapters as A

QUERIES, SQL = {}, {}

# Split bounds inside the labelled (event) period: 2024-01-18 and 2024-01-24 UTC.
CFG = ML.MLConfig(train_end=1_705_536_000_000, valid_end=1_706_054_400_000, run_id="r1")
_MODELS: dict[str, tuple] = {}


def _dataset(spark, sf):
    b = bars_all(spark, sf)
    d1 = A.bars_events(spark, sf, "1d").unionByName(A.bars_lineitem(spark, sf))
    return ML.build_dataset(b, d1, CFG)


def _model(spark, sf):
    key = f"{spark.sparkContext.applicationId}:{sf}:{listing(spark, sf)}"
    if key not in _MODELS:
        ds = cut_lineage(_dataset(spark, sf))  # reliable checkpoint: short plans for 80 boosting rounds
        model, metrics = ML.train(ds, CFG)
        _MODELS[key] = (ds, model, metrics)
    return _MODELS[key]


def e2_barrier_dataset(spark, sf):
    prep(spark)
    d = _dataset(spark, sf)
    return d.select("exchange", "symbol", "interval", "entry_dt_utc", "split", "label", "dow_syd", *ML.FEATURES)


def m3_m4_train_metrics(spark, sf):
    prep(spark)
    return _model(spark, sf)[2]


def m5_importances(spark, sf):
    prep(spark)
    _, model, _ = _model(spark, sf)
    return ML.importances(model, spark)


def m6_permutation_importance(spark, sf):
    prep(spark)
    ds, model, _ = _model(spark, sf)
    top = [r["feature"] for r in ML.importances(model, spark).limit(15).collect() if r["feature"] in ML.FEATURES]
    return ML.permutation_importance(model, ds, top, frac=0.5, seed=42, split="valid")


def m7_predictions(spark, sf):
    prep(spark)
    ds, model, _ = _model(spark, sf)
    return ML.score(model, ds, CFG)


def m8_ml_filter(spark, sf):
    prep(spark)
    ds, model, _ = _model(spark, sf)
    preds = ML.score(model, ds, CFG)
    trades = B.signal_backtest(G.momentum_signals(bars_all(spark, sf)), "sig_breakout_long", run_id="r1")
    return ML.ml_filter(trades, preds, 0.55)


def m9_latest_run(spark, sf):
    prep(spark)
    ds, model, _ = _model(spark, sf)
    return ML.latest_run(ML.score(model, ds, CFG))


for _n, _f in list(globals().items()):
    if callable(_f) and (_n[:1] == "m" and _n[1:2].isdigit() or _n.startswith("e2_")):
        QUERIES[_n] = _f
