"""Registered queries: quantile sketches (A9), JSON as VARIANT (N1-N3, A17), the run log (M9, M10), the filter by fixed
predictions (M8) and SQL for queries that plain SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import sqlsrc
from tidemark.catalog.common import bars_all, prep
from tidemark.catalog.q_misc import SNAP_COLS, SQL as MISC
from tidemark.catalog.q_outcomes import SQL as OUT, _grid, _labels, rnd
from tidemark.operators import snapshots as N
from tidemark.operators import stats as S
from tidemark.plans import barrier_ml as ML
from tidemark.schemas import SNAPSHOT_ROW
from tidemark.sources import adapters as A
from tidemark.streaming.streams import scratch

QUERIES, SQL = {}, {}
K = ["exchange", "symbol", "interval"]
KS = ", ".join(K)
PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


def a9_sketch_quantiles(spark, sf):
    """Volume quantiles per symbol from sketches stored per key and day, each held against its exact rank."""
    b = bars_all(spark, sf).withColumn("day", F.floor(F.col("open_time") / 86_400_000))
    path = scratch(spark, "sketches")
    S.quantile_sketches(b, [*K, "day"], "volume").write.parquet(path)
    q = S.merged_quantiles(spark.read.parquet(path), ["exchange", "symbol"], PROBS)
    e = S.rank_errors(b, ["exchange", "symbol"], "volume", q)
    return e.select("exchange", "symbol", "n", "q", (F.col("rank_error") <= 0.01).alias("within_1_percent"))


SQL["a9_sketch_quantiles"] = f"""SELECT exchange, symbol, count(volume) AS n, q, TRUE AS within_1_percent
FROM ({sqlsrc.bars_all()}), (VALUES {', '.join(f'({p}::DOUBLE)' for p in PROBS)}) p(q) GROUP BY exchange, symbol, q"""


def n3_variant_rows(spark, sf):
    prep(spark)
    r = N.snapshot_rows_variant(A.snapshot_cache(spark, sf))
    return r.select("snapshot_id", "snapshot_exchange", "snapshot_ts", "symbol", "exchange", "liquidity_rank",
                    "liquidity_top200", "signal_strength", "mtf_summary", "sector_tags", *SNAP_COLS)


SQL["n3_variant_rows"] = MISC["n3_snapshot_rows"]


def a17_variant_keys(spark, sf):
    prep(spark)
    return N.variant_keys(A.table(spark, sf, "events"), "props")


SQL["a17_variant_keys"] = """SELECT key, count(*) AS n_docs, count(*) FILTER (json_type(json_extract(props, '$."' || key || '"')) <> 'NULL') AS n_values
FROM (SELECT props, unnest(json_keys(props)) AS key FROM events) GROUP BY key"""


# ------------------------------------------------------------------ runs

RUNS = (("r1", 24, 1_705_000_000_000), ("r2", 48, 1_706_000_000_000))


def m9_m10_run_log(spark, sf):
    """Label counts of two runs, logged by run id; the first is logged again and adds nothing.  All runs, and which is the latest."""
    path = scratch(spark, "runs")
    lab = _labels(spark, sf)
    for run, _, finished in (*RUNS, RUNS[0]):
        part = lab if run == "r1" else lab.where("label_timeout = 0")
        ML.log_run(spark, path, run, part.agg(F.count(F.lit(1)).alias("n_rows"), F.count("label").alias("n_labels"), F.sum("label").alias("n_wins")), finished)
    log = ML.run_log(spark, path)
    last = ML.latest_logged_run(log).select("run_id", F.lit(True).alias("latest"))
    return log.join(last, "run_id", "left").select("run_id", "finished_ms", "n_rows", "n_labels", "n_wins", F.coalesce("latest", F.lit(False)).alias("latest"))


_LAB = OUT["b8_b9_barrier_labels"]
SQL["m9_m10_run_log"] = f"""WITH lab AS ({_LAB})
SELECT 'r1' AS run_id, {RUNS[0][2]} AS finished_ms, count(*) AS n_rows, count(label) AS n_labels, sum(label)::BIGINT AS n_wins, FALSE AS latest FROM lab
UNION ALL SELECT 'r2', {RUNS[1][2]}, count(*), count(label), sum(label)::BIGINT, TRUE FROM lab WHERE label_timeout = 0"""


def m8_fixed_filter(spark, sf):
    """Grid trades filtered by fixed predictions (a hash of run and entry) of two runs, of which the later one counts."""
    t = _grid(spark, sf)
    e = t.select(*K, "entry_time_utc").distinct()
    e = e.withColumn("run_id", F.explode(F.array(F.lit("r1"), F.lit("r2")))).where("run_id = 'r1' OR symbol < 'p'")
    text = F.concat_ws("::", "run_id", *K, F.col("entry_time_utc").cast("string"))
    # the later run's entries are later by a day
    preds = e.withColumns({"p_win": F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") / F.lit(1 << 28), "entry_dt_utc": F.col("entry_time_utc")})
    newest = e.select(F.max("entry_time_utc").alias("entry_dt_utc")).select(
        *[F.lit(None).cast("string").alias(k) for k in K], F.lit("r2").alias("run_id"), (F.col("entry_dt_utc") + F.expr("INTERVAL 1 DAY")).alias("entry_dt_utc"), F.lit(0.0).alias("p_win"))
    kept = ML.ml_filter(t, preds.select(*K, "run_id", "entry_dt_utc", "p_win").unionByName(newest), 0.55)
    return rnd(kept.select(*K, "entry_time_utc", "max_hold_bars", "atr_mult_stop", "p_win"), ["p_win"])


SQL["m8_fixed_filter"] = f"""WITH t AS ({OUT['b7_b10_signal_backtest']}),
p AS (SELECT *, CASE WHEN symbol < 'p' THEN ('0x' || substr(md5(concat_ws('::', 'r2', {KS}, CAST(entry_time_utc AS VARCHAR))), 1, 7))::BIGINT::DOUBLE / 268435456 ELSE 0.0 END AS p FROM t)
SELECT {KS}, entry_time_utc, max_hold_bars, atr_mult_stop, {sqlsrc.rnd('p')} AS p_win FROM p WHERE p >= 0.55"""


for _n, _f in list(globals().items()):
    if callable(_f) and _n[:1] in ("a", "n", "m") and _n[1:2].isdigit():
        QUERIES[_n] = _f
