"""End-to-end barrier-label dataset and classifier (E2: B8, B9, I*, J3, M1-M10).

Pipeline: intraday bars -> window features + recursive indicators -> daily
context attached by an as-of join on the daily bar's *close* (no lookahead,
SURVEY §8-3) -> barrier labels -> time split -> Spark ML GBT.  Permutation
importance shuffles one feature at a time with a hash-salted, partitioned
permutation (no single-partition window).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import timeutil as TU
from tidemark.operators import indicators as I
from tidemark.operators import joins as J
from tidemark.operators import outcomes as B
from tidemark.operators.joins import null_safe_join
from tidemark.schemas import KEY

CORE = ["atr_entry", "atrp", "trend_up", "trend_strength", "ret_1", "ret_vol", "range", "body_to_range", "upper_wick",
        "lower_wick", "gap", "dist_to_hh_atr", "dist_to_ll_atr", "vol_z"]
TECH = ["ema_20", "ema_50", "ema_ratio", "rsi_14", "adx_14", "macd_line", "macd_signal", "macd_hist", "bb_bw_20",
        "donch_pos_20", "mom_logret_3", "mom_logret_6", "mom_logret_12"]
DAILY = ["sma_20d_1d", "sma_50d_1d", "trend_up_1d", "ret_vol_20d_1d", "rsi_14_1d", "macd_hist_1d", "adx_14_1d"]
DAILY_SRC = {"sma_20d_1d": "sma_20d", "sma_50d_1d": "sma_50d", "trend_up_1d": "trend_up_1d",
             "ret_vol_20d_1d": "ret_vol_20d", "rsi_14_1d": "rsi_14_1d", "macd_hist_1d": "macd_hist_1d",
             "adx_14_1d": "adx_14_1d"}
FEATURES = CORE + TECH + DAILY
CAT = ["dow_syd"]


@dataclass(frozen=True)
class MLConfig:
    train_end: int          # epoch ms, half-open split bounds (T8)
    valid_end: int
    tp_atr: float = 3.0
    sl_atr: float = 2.0
    w_bars: int = 24
    policy: str = "discard_both"
    max_depth: int = 5
    max_iter: int = 80
    step: float = 0.1
    seed: int = 42
    threshold: float = 0.55
    run_id: str = "run"
    daily_tolerance_ms: int = 2 * 86_400_000


def build_dataset(bars: DataFrame, bars_1d: DataFrame, cfg: MLConfig) -> DataFrame:
    """One row per labelled entry with core, technical and daily features."""
    feat = I.ml_window_features(bars)
    tech = I.tech_features(feat.select(*KEY, "bar_idx", "open_time", "open", "high", "low", "close", "volume"))
    feat = null_safe_join(feat, tech.select(*KEY, "bar_idx", *TECH), [*KEY, "bar_idx"])
    lab = B.barrier_labels(feat, cfg.tp_atr, cfg.sl_atr, cfg.w_bars, cfg.policy, "atr", cfg.run_id)
    d1 = I.daily_context(bars_1d).select(
        "exchange", "symbol", (F.col("close_time") + 1).alias("entry_open_time"),
        *[F.col(DAILY_SRC[c]).alias(c) for c in DAILY])
    lab = J.asof_backward(lab, d1, on="entry_open_time", by=["exchange", "symbol"], right_cols=DAILY,
                          tolerance=cfg.daily_tolerance_ms, prefix="d_")
    lab = lab.select(*[c for c in lab.columns if c != "d_entry_open_time"]) \
        .withColumnsRenamed({f"d_{c}": c for c in DAILY})
    lab = TU.add_local_time(lab, "entry_open_time", "entry")
    return lab.withColumns({"dow_syd": TU.weekday_short("entry_dt_syd"),
                            "split": TU.time_split("entry_open_time", cfg.train_end, cfg.valid_end),
                            "trend_up_1d": F.col("trend_up_1d").cast("double"),
                            "trend_up": F.col("trend_up").cast("double")})


def pipeline(cfg: MLConfig, features: Sequence[str] = FEATURES, categorical: bool = True) -> Pipeline:
    """M1-M3: weekday index (unseen kept), median imputation (GBT cannot take
    NULL/NaN), assembler, GBT with a fixed seed.  Trees refuse a category column of more values than training rows:
    there (``categorical`` False) the index is a number, without the attributes that make it a category."""
    imp_out = [f"{c}__i" for c in features]
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_idx" if categorical else f"{c}_cat", handleInvalid="keep") for c in CAT]
    if not categorical:
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(f'{c}_cat + 0D AS {c}_idx' for c in CAT)} FROM __THIS__"))
    if imp_out:
        stages.append(Imputer(inputCols=list(features), outputCols=imp_out, strategy="median"))
    stages.append(VectorAssembler(inputCols=imp_out + [f"{c}_idx" for c in CAT], outputCol="features",
                                  handleInvalid="keep"))
    stages.append(GBTClassifier(featuresCol="features", labelCol="label", maxDepth=cfg.max_depth,
                                maxIter=cfg.max_iter, stepSize=cfg.step, seed=cfg.seed))
    return Pipeline(stages=stages)


def prepare(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Labelled rows with NaN turned into NULL (the imputer handles NULL)."""
    d = df.where(F.col("label").isNotNull()).withColumn("label", F.col("label").cast("double"))
    return d.withColumns({c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features})


def train(dataset: DataFrame, cfg: MLConfig) -> tuple[PipelineModel | None, DataFrame]:
    """M3 + M4 + M10: fit on the train split; metrics row with AUCs.  Without a labelled row in
    the train split (every entry may meet both barriers in one bar) there is no model: None and AUCs of NULL."""
    d = prepare(dataset)
    tr = d.where(F.col("split") == "train")
    # a feature with no value at all in the training split cannot be imputed: leave it out
    nn = tr.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in FEATURES],
                *[F.count_distinct(c).alias(c) for c in CAT]).first().asDict()
    used = [c for c in FEATURES if nn[c] > 0]
    model = None
    if nn["_rows"]:
        tr = tr.persist()
        model = pipeline(cfg, used, categorical=all(nn[c] + 1 <= nn["_rows"] for c in CAT)).fit(tr)  # one more for unseen values
        tr.unpersist()
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    out = {}
    for s in ("train", "valid", "test"):
        part = d.where(F.col("split") == s)
        out[f"n_{s}"] = part.count()
        out[f"auc_{s}"] = float(ev.evaluate(model.transform(part))) if model and out[f"n_{s}"] and _two_classes(part) else None
    spark = dataset.sparkSession
    metrics = spark.createDataFrame(
        [(cfg.run_id, out["n_train"], out["n_valid"], out["n_test"], out["auc_train"], out["auc_valid"],
          out["auc_test"], cfg.max_depth, cfg.max_iter, cfg.step)],
        "run_id string, n_train long, n_valid long, n_test long, auc_train double, auc_valid double, "
        "auc_test double, max_depth int, max_iter int, step double")
    return model, metrics


def _two_classes(df: DataFrame) -> bool:
    return df.select("label").distinct().limit(2).count() == 2


def importances(model: PipelineModel | None, spark: SparkSession) -> DataFrame:
    """M5: GBT importances by assembled input, highest first (no model: no rows)."""
    if model is None:
        return spark.createDataFrame([], "feature string, importance double")
    gbt, asm = model.stages[-1], model.stages[-2]
    names = [c[:-3] if c.endswith("__i") else c for c in asm.getInputCols()]
    rows = list(zip(names, [float(x) for x in gbt.featureImportances.toArray()]))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(),
                                                                                     "feature")


def hash_sample(df: DataFrame, frac: float, seed: int, id_cols: Sequence[str]) -> DataFrame:
    """Reproducible Bernoulli sample keyed by row identity (independent of
    partitioning, unlike ``sample``)."""
    h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in id_cols]), F.lit(1_000_000))
    return df.where(h < F.lit(int(frac * 1_000_000)))


def permutation_importance(model: PipelineModel | None, dataset: DataFrame, top: Sequence[str], frac: float = 0.05,
                           seed: int = 42, split: str = "valid") -> DataFrame:
    """M6 + J8: base AUC minus AUC with one feature permuted, on a hash
    sample of a split.  The loop runs one small evaluation job per feature.  No model: no rows."""
    if model is None:
        return dataset.sparkSession.createDataFrame([], "feature string, auc_drop double, auc_after double")
    d = prepare(dataset).where(F.col("split") == split)
    s = hash_sample(d, frac, seed, [*KEY, "open_time"]).withColumn("_rid", F.xxhash64(*[F.col(c) for c in KEY],
                                                                                     F.col("open_time")))
    s = s.persist()
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    if not _two_classes(s):
        s.unpersist()
        return dataset.sparkSession.createDataFrame([], "feature string, auc_drop double, auc_after double")
    base = ev.evaluate(model.transform(s))
    rows = []
    for f in top:
        auc = ev.evaluate(model.transform(J.hash_shuffle_column(s, f, seed, "_rid")))
        rows.append((f, float(base - auc), float(auc)))
    s.unpersist()
    return dataset.sparkSession.createDataFrame(rows, "feature string, auc_drop double, auc_after double") \
        .orderBy(F.col("auc_drop").desc(), "feature")


def score(model: PipelineModel | None, dataset: DataFrame, cfg: MLConfig) -> DataFrame:
    """M7: p_win = P(class 1), take_trade = p_win >= threshold.  No model: p_win NULL, no trade taken."""
    p = prepare(dataset)
    if model is None:
        p = p.withColumn("p_win", F.lit(None).cast("double"))
    else:
        p = model.transform(p).withColumn("p_win", F.get(vector_to_array("probability"), 1))
    return p.select(F.lit(cfg.run_id).alias("run_id"), *KEY, "entry_dt_utc", "entry_dt_syd", "split",
                    F.col("label").cast("int").alias("label"), "p_win",
                    F.coalesce((F.col("p_win") >= cfg.threshold).cast("int"), F.lit(0)).alias("take_trade"))


def log_run(spark: SparkSession, path: str, run_id: str, metrics: DataFrame, finished: int) -> bool:
    """Append the one-row ``metrics`` of a run to the run log at ``path``, a folder per run.  A run is committed once, by its id:
    logging it again changes nothing and returns False.  ``finished`` (epoch ms) orders the runs."""
    part = f"{path}/run_id={run_id}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{part}/_SUCCESS")
    done = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    if not done:  # an attempt that was lost left no marker and is replaced
        metrics.drop("run_id").withColumn("finished_ms", F.lit(finished).cast("long")).coalesce(1).write.mode("overwrite").parquet(part)
    return not done


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """The logged runs (run_id as text)."""
    return spark.read.option("mergeSchema", True).parquet(path).withColumn("run_id", F.col("run_id").cast("string"))


def latest_logged_run(log: DataFrame) -> DataFrame:
    """M9: the run that finished last (ties: the greatest id)."""
    best = log.agg(F.max(F.struct("finished_ms", "run_id")).alias("_b")).select(F.col("_b.run_id").alias("run_id"))
    return log.join(best, "run_id")


def latest_run(preds: DataFrame) -> DataFrame:
    """M9: the run id with the newest entry time (one row)."""
    return preds.agg(F.max_by("run_id", "entry_dt_utc").alias("run_id"))


def ml_filter(trades: DataFrame, preds: DataFrame, threshold: float = 0.55) -> DataFrame:
    """M8: attach p_win by (key, entry time) of the latest run; missing -> 0;
    keep trades with p_win >= threshold."""
    run = latest_run(preds)
    p = preds.join(run, "run_id").select(*KEY, F.col("entry_dt_utc").alias("entry_time_utc"), "p_win")
    t = null_safe_join(trades, p, [*KEY, "entry_time_utc"], "left").withColumn("p_win", F.coalesce("p_win", F.lit(0.0)))
    return t.where(F.col("p_win") >= threshold)
