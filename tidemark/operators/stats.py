"""Aggregations and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def value_counts(df: DataFrame, cols: Sequence[str] | str, top_n: int | None = None) -> DataFrame:
    """Group counts ordered by count desc (NULL is a group), top-N."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), *cols)
    return g.limit(top_n) if top_n else g


def bars_summary(bars: DataFrame) -> DataFrame:
    """A2: per key bar count, first/last close time, close range, mean volume."""
    return bars.groupBy("exchange", "symbol", "interval").agg(
        F.count(F.lit(1)).alias("n_bars"), F.min("close_time").alias("first_close_time"),
        F.max("close_time").alias("last_close_time"), F.min("close").alias("min_close"),
        F.max("close").alias("max_close"), F.avg("volume").alias("avg_volume"))


def plan_summary(plans: DataFrame) -> DataFrame:
    """A3: plans by side and entry type: count, mean reward:risk and ATR."""
    return plans.groupBy("side", "entry_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("rr_tp1").alias("avg_rr1"), F.avg("rr_tp2").alias("avg_rr2"),
        F.avg("rr_tp3").alias("avg_rr3"), F.avg("atr").alias("avg_atr"))


def top_symbols(plans: DataFrame, n: int = 20) -> DataFrame:
    """A4: symbols with the most plans (NULL rr excluded), mean rr_tp1."""
    return (plans.where(F.col("rr_tp1").isNotNull()).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("n_plans"), F.avg("rr_tp1").alias("avg_rr1"))
            .orderBy(F.col("n_plans").desc(), "symbol").limit(n))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _unpivot(wide: DataFrame, names: Sequence[str], stats: Sequence[str]) -> DataFrame:
    parts = ", ".join(f"'{c}', " + ", ".join(f"`{c}__{s}`" for s in stats) for c in names)
    cols = ", ".join(stats)
    return wide.selectExpr(f"stack({len(names)}, {parts}) AS (column, {cols})")


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A5: min / max / mean of every numeric column, one aggregate + unpivot."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"), F.avg(x).alias(f"{c}__mean")]
    return _unpivot(df.agg(*aggs), cols, ["min", "max", "mean"])


def describe(df: DataFrame, cols: Sequence[str] | None = None,
             pcts: Sequence[float] = (0.01, 0.05, 0.5, 0.95, 0.99)) -> DataFrame:
    """Count, mean, std and exact percentiles (linear interpolation,
    as pandas) per numeric column; percentiles are distributed order
    statistics over the unpivoted values (``exact_quantiles``)."""
    cols = list(cols or numeric_columns(df))
    pn = [f"p{round(p * 100)}" for p in pcts]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std")]
    moments = _unpivot(df.agg(*aggs), cols, ["count", "mean", "std"])
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {stack}) AS (column, value)")
    q = exact_quantiles(long, ["column"], "value", list(pcts), pn)
    return moments.join(q, "column", "left")


def null_fraction(df: DataFrame) -> DataFrame:
    """Fraction of NULLs per column, highest first."""
    aggs = [F.avg(F.col(c).isNull().cast("double")).alias(f"{c}__null_frac") for c in df.columns]
    return _unpivot(df.agg(*aggs), df.columns, ["null_frac"]).orderBy(F.col("null_frac").desc(), "column")


def win_rate(r: Column | str) -> Column:
    """Share of r > 0; NULL counts as a loss (as the reference)."""
    r = F.col(r) if isinstance(r, str) else r
    return F.avg(F.when(r > 0, 1.0).otherwise(0.0))


def quantiles(x: Column | str, probs: Sequence[float], exact: bool = True, accuracy: int = 10000) -> list[Column]:
    """Exact (``percentile``) or approximate (``percentile_approx``)."""
    x = F.col(x) if isinstance(x, str) else x
    if exact:
        return [F.percentile(x, p).alias(f"q{round(p * 100)}") for p in probs]
    return [F.percentile_approx(x, p, accuracy).alias(f"q{round(p * 100)}") for p in probs]


def quantile_sketches(df: DataFrame, by: Sequence[str], col: str, k: int = 400) -> DataFrame:
    """A mergeable KLL sketch of ``col`` per group (e.g. key and day), with its count: a few KB whatever the group's size.  NULL and
    NaN are left out, and so are groups without a value."""
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    return (df.where(x.isNotNull()).groupBy(*by)
            .agg(F.kll_sketch_agg_double(x, k).alias("sketch"), F.count(F.lit(1)).alias("n")))


def merged_quantiles(sketches: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(``by``, n, q, value): quantiles of coarser groups from stored sketches, without the rows."""
    by = list(by)
    m = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("_s"), F.sum("n").alias("n"))
    q = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("q"), F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias("value")) for p in probs]))
    return m.select(*by, "n", q.alias("_q")).select(*by, "n", "_q.*")


def rank_errors(df: DataFrame, by: Sequence[str], col: str, answers: DataFrame) -> DataFrame:
    """``answers`` (``by``, n, q, value) with ``rank_error``: how far q is outside the share of rows below and up to the value.
    One pass of conditional sums per group, for a handful of answers."""
    by = list(by)
    got = answers.groupBy(*by).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("q", "value"))).alias("_a"))
    size = answers.select("q").distinct().count()
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    d = join_null_safe(df.select(*by, x.alias("_x")).where("_x IS NOT NULL"), got, by)
    value = lambda i: F.get("_a", F.lit(i))["value"]
    d = d.groupBy(*by).agg(*[f(F.when(c, 1).otherwise(0)).alias(f"_{name}{i}") for i in range(size) for f, name, c in
                             ((F.sum, "lt", F.col("_x") < value(i)), (F.sum, "le", F.col("_x") <= value(i)))])
    d = join_null_safe(d, got, by)
    rows = F.explode(F.array(*[F.struct(F.get("_a", F.lit(i))["q"].alias("q"), value(i).alias("value"), (F.col(f"_lt{i}") / F.col("n")).alias("lo"),
                                        (F.col(f"_le{i}") / F.col("n")).alias("hi")) for i in range(size)]))
    d = d.select(*by, "n", rows.alias("_r")).select(*by, "n", "_r.*")
    return d.withColumn("rank_error", F.greatest(F.col("lo") - F.col("q"), F.col("q") - F.col("hi"), F.lit(0.0))).drop("lo", "hi")


def weekday_hour_counts(df: DataFrame, ts_local: str) -> DataFrame:
    """Counts by local weekday (Mon..Sun) and hour."""
    return (df.groupBy(F.date_format(ts_local, "E").alias("dow"), F.hour(ts_local).alias("hour"))
            .agg(F.count(F.lit(1)).alias("n")))


def tag_frequency(df: DataFrame, tags_col: str, top_n: int | None = None) -> DataFrame:
    """Explode an array-of-tags column and count tags."""
    t = df.select(F.explode(tags_col).alias("tag"))
    return value_counts(t, "tag", top_n)


def json_keys_seen(df: DataFrame, json_col: str) -> DataFrame:
    """Distinct top-level keys seen in a JSON text column, with counts."""
    k = df.select(F.explode(F.json_object_keys(json_col)).alias("key"))
    return k.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"))


def exact_quantiles(df: DataFrame, by: Sequence[str], col: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (``percentile`` / pandas /
    ``quantile_cont``) per group (NULL is a group), without holding a group in one task.

    Equal values are counted first (which combines before the shuffle, so a
    frequent value costs one row); the distinct values are range-partitioned by
    (group, value), and a value's ranks follow from running counts inside the partition plus the counts
    of the same group in earlier partitions (a small per-partition table).
    Only the values that cover ranks floor(h) and ceil(h), h = (n - 1) p, survive to
    the final per-group aggregate.  The counted frame is checkpointed so
    partition ids are stable.
    """
    from tidemark.operators.joins import null_safe_join
    from tidemark.session import cut_lineage
    by = list(by)
    names = list(names or [f"q{round(p * 100)}" for p in probs])
    p = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = df.select(*by, F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    s = v.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c")).repartitionByRange(p, *by, "_v")
    s = cut_lineage(s.withColumn("_pid", F.spark_partition_id()))
    part = s.groupBy(*by, "_pid").agg(F.sum("_c").alias("_pc"))
    w = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select(*by, "_pid", F.coalesce(F.sum("_pc").over(w), F.lit(0)).alias("_off"),
                       F.sum("_pc").over(Window.partitionBy(*by)).alias("_n"))
    inside = Window.partitionBy(*by, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    r = null_safe_join(s.withColumn("_to", F.sum("_c").over(inside)), part, [*by, "_pid"])
    r = r.withColumn("_to", F.col("_off") + F.col("_to") - 1).withColumn("_from", F.col("_to") - F.col("_c") + 1)
    ranks = [rank for q in probs for rank in (F.floor((F.col("_n") - 1) * float(q)), F.ceil((F.col("_n") - 1) * float(q)))]
    r = r.where(F.exists(F.array(*ranks), lambda x: x.between(F.col("_from"), F.col("_to"))))
    g = r.groupBy(*by).agg(F.first("_n").alias("_n"), F.collect_list(F.struct("_from", "_to", "_v")).alias("_vs"))
    outs = []
    for q, nm in zip(probs, names):
        h = (F.col("_n") - 1) * float(q)
        at = lambda rank: F.element_at(F.filter("_vs", lambda x: rank.between(x["_from"], x["_to"])), 1)["_v"]
        vlo, vhi = at(F.floor(h)), at(F.ceil(h))
        outs.append((vlo + (h - F.floor(h)) * (vhi - vlo)).alias(nm))
    return g.select(*by, *outs)


def join_null_safe(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` treating NULL = NULL (group keys may be NULL)."""
    bb = b.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = [a[k].eqNullSafe(bb[f"__k_{k}"]) for k in keys]
    return a.join(bb, cond, how).drop(*[f"__k_{k}" for k in keys])
