"""Typed projections, coercion and predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import KEY


def num(c: str) -> Column:
    """Text or number -> DOUBLE, bad text -> NULL (ANSI-safe)."""
    return F.expr(f"try_cast(`{c}` AS double)")


def numeric_coerce(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: num(c) for c in cols})


def safe_ratio(a, b) -> Column:
    """NULL when the denominator is 0 or NULL."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.try_divide(a, b)


def silver_ohlc(df: DataFrame) -> DataFrame:
    """Typed bar projection with ``open_ts`` timestamp."""
    return df.select(
        "exchange", "symbol", "interval",
        F.col("open_time").cast("long").alias("open_time"),
        F.col("close_time").cast("long").alias("close_time"),
        F.timestamp_millis(F.col("open_time").cast("long")).alias("open_ts"),
        *[num(c).alias(c) for c in ("open", "high", "low", "close", "volume")],
    )


def silver_alerts(df: DataFrame) -> DataFrame:
    """Typed alert projection."""
    return df.select(
        F.col("id").cast("long").alias("alert_id"), F.col("ts").cast("long").alias("alert_ts"),
        "exchange", "symbol", F.upper("signal").alias("signal"), "source_tf",
        num("price").alias("alert_price"), num("setup_score").alias("setup_score"), "setup_grade",
    )


def silver_plans(df: DataFrame) -> DataFrame:
    """Typed plan projection, side upper-cased."""
    return df.select(
        F.col("id").cast("long").alias("plan_id"), F.col("alert_id").cast("long").alias("alert_id"),
        F.col("ts").cast("long").alias("plan_ts"), "exchange", "symbol", F.upper("side").alias("side"),
        "entry_type", *[num(c).alias(c) for c in ("entry_price", "stop_loss", "tp1", "tp2", "tp3", "atr",
                                                   "atr_mult", "risk_per_unit", "rr_tp1", "rr_tp2", "rr_tp3")],
        "swing_ref",
    )


def where_eq(df: DataFrame, **eq) -> DataFrame:
    """Optional equality filters; ``None`` values are ignored."""
    for c, v in eq.items():
        if v is not None:
            df = df.where(F.col(c) == F.lit(v))
    return df


def where_in(df: DataFrame, col: str, values) -> DataFrame:
    """P5: set-membership filter."""
    return df.where(F.col(col).isin(list(values))) if values is not None else df


def with_plan_timeframe(plans: DataFrame, alerts: DataFrame, default: str = "15m") -> DataFrame:
    """The alert's timeframe for each plan, default ``'15m'``."""
    a = alerts.select(F.col("alert_id"), F.col("source_tf").alias("_tf"))
    return (plans.join(a, "alert_id", "left")
            .withColumn("tf", F.coalesce(F.col("_tf"), F.lit(default))).drop("_tf"))


def distinct_symbols(bars: DataFrame, exchange: str | None = None) -> DataFrame:
    """Ordered distinct symbols (optionally one exchange)."""
    return where_eq(bars, exchange=exchange).select("symbol").distinct().orderBy("symbol")


def optional_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` absent from ``df`` become typed NULLs."""
    have = set(df.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in have}
    return df.withColumns(missing) if missing else df


def key_cols() -> list[Column]:
    return [F.col(k) for k in KEY]
