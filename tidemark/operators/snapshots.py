"""JSON market snapshots.

A snapshot document holds a list of per-symbol rows, either as the whole
payload or under a wrapper key.  Parsing stays in Spark's JSON functions:
the document is read as ``map<string,string>`` (nested values come back as
raw JSON text, in document order), the row array is chosen by the
reference's priority rules, and ``from_json`` into the row schema gives
typed rows with absent attributes as NULL.  Bad JSON yields no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import SNAPSHOT_ROW

# Wrapper keys tried in this order, top level and one level down.
WRAPPER_KEYS = ("data", "result", "results", "items", "payload", "snapshot", "markets", "coins", "pairs", "rows",
                "assets")

MAP = "map<string,string>"


def _is_array(txt: Column) -> Column:
    return F.startswith(F.ltrim(txt), F.lit("["))


def _is_object(txt: Column) -> Column:
    return F.startswith(F.ltrim(txt), F.lit("{"))


def safe_json_map(txt: Column) -> Column:
    """Object text -> map of raw values; bad JSON or non-object -> NULL."""
    return F.when(_is_object(txt), F.from_json(txt, MAP, {"mode": "PERMISSIVE"}))


def snapshot_array(txt: Column) -> Column:
    """The JSON text of the row array, by the reference's rules: the
    payload itself if it is an array; else the first wrapper key (in the fixed
    order) whose value is an array, or an object holding an array under a
    wrapper key; else the first array value in document order, or one level
    down."""
    keys = F.array(*[F.lit(k) for k in WRAPPER_KEYS])
    rank = lambda e: F.array_position(keys, e["key"])
    first = lambda entries: F.get(F.filter(entries, lambda e: _is_array(e["value"])), 0)["value"]
    inside = lambda v: F.map_entries(F.from_json(F.when(_is_object(v), v), MAP))

    def by_key_order(entries: Column, value) -> Column:
        """The first non-NULL ``value`` of the entries under wrapper keys."""
        named = F.transform(F.filter(entries, lambda e: rank(e) > 0), lambda e: F.struct(rank(e).alias("p"), value(e["value"]).alias("v")))
        return F.get(F.array_sort(F.filter(named, lambda x: x["v"].isNotNull())), 0)["v"]

    array_of = lambda v: F.when(_is_array(v), v)

    def choose(m: Column) -> Column:
        entries = F.map_entries(m)
        wrapped = by_key_order(entries, lambda v: F.coalesce(array_of(v), by_key_order(inside(v), array_of)))
        down = F.get(F.filter(F.transform(entries, lambda e: first(inside(e["value"]))), lambda x: x.isNotNull()), 0)
        return F.coalesce(wrapped, first(entries), down)

    # the one-element array binds the parsed document, so that it is parsed once
    return F.when(_is_array(txt), F.trim(txt)).otherwise(F.get(F.transform(F.array(safe_json_map(txt)), choose), 0))


def snapshot_rows(snaps: DataFrame, json_col: str = "snapshot_json", schema=SNAPSHOT_ROW,
                  keep: Sequence[str] = ("id", "exchange", "ts")) -> DataFrame:
    """One typed row per element of the chosen array (snapshot id,
    exchange and ts carried as ``snapshot_id``, ``snapshot_exchange``,
    ``snapshot_ts``)."""
    arr = F.from_json(snapshot_array(F.col(json_col)), T.ArrayType(schema))
    ren = {"id": "snapshot_id", "exchange": "snapshot_exchange", "ts": "snapshot_ts"}
    d = snaps.select(*[F.col(c).alias(ren.get(c, c)) for c in keep], F.explode(arr).alias("_r"))
    return d.where(F.col("_r").isNotNull()).select(*[ren.get(c, c) for c in keep], "_r.*")


def variant_array(doc: Column) -> Column:
    """N2 on VARIANT: the row array of a parsed document, by the rules of ``snapshot_array``; a VARIANT object has no document order, so
    where no wrapper key holds an array the first one by key name is taken."""
    kind = lambda v: F.schema_of_variant(v)
    array_of = lambda v: F.when(F.startswith(kind(v), F.lit("ARRAY")), v)
    fields = lambda v: F.try_variant_get(F.when(F.startswith(kind(v), F.lit("OBJECT")), v), "$", "map<string,variant>")
    wrapped = lambda m, value: F.get(F.filter(F.transform(F.array(*[F.lit(k) for k in WRAPPER_KEYS]), lambda k: value(F.try_element_at(m, k))),
                                              lambda x: x.isNotNull()), 0)
    named = lambda m, value: F.get(F.filter(F.transform(F.map_values(m), value), lambda x: x.isNotNull()), 0)

    def choose(m: Column) -> Column:
        return F.coalesce(wrapped(m, lambda v: F.coalesce(array_of(v), wrapped(fields(v), array_of))), named(m, array_of),
                          named(m, lambda v: named(fields(v), array_of)))

    return F.coalesce(array_of(doc), F.get(F.transform(F.array(fields(doc)), choose), 0))


def snapshot_rows_variant(snaps: DataFrame, json_col: str = "snapshot_json", schema: T.StructType = SNAPSHOT_ROW,
                          keep: Sequence[str] = ("id", "exchange", "ts")) -> DataFrame:
    """N1-N3 on VARIANT: each document is parsed once (bad JSON gives no rows); a field that does not fit its type is NULL."""
    ren = {"id": "snapshot_id", "exchange": "snapshot_exchange", "ts": "snapshot_ts"}
    doc = snaps.select(*[F.col(c).alias(ren.get(c, c)) for c in keep], F.try_parse_json(json_col).alias("_v"))
    row = doc.select(*[ren.get(c, c) for c in keep], F.explode(F.try_variant_get(variant_array(F.col("_v")), "$", "array<variant>")).alias("_r"))
    row = row.where(F.startswith(F.schema_of_variant("_r"), F.lit("OBJECT")))
    return row.select(*[ren.get(c, c) for c in keep], *[F.try_variant_get("_r", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields])


def variant_keys(df: DataFrame, json_col: str) -> DataFrame:
    """A17 on VARIANT: distinct top-level keys of the JSON objects of a column, with the number of documents and of values that are not null."""
    docs = df.select(F.try_parse_json(json_col).alias("_v")).where(F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT")))
    each = docs.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    return each.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(~F.is_variant_null("value")).alias("n_values"))


def latest_snapshot(snaps: DataFrame, per_exchange: bool = True, latest: bool = True) -> DataFrame:
    """The newest (or oldest) snapshot, optionally per exchange (a hash
    aggregate over (ts, id); the JSON payload is carried by a key join)."""
    keys = ["exchange"] if per_exchange else []
    pick = F.max_by if latest else F.min_by
    best = snaps.groupBy(*keys).agg(pick(F.col("id"), F.struct("ts", "id")).alias("id"))
    return snaps.join(best, [*keys, "id"], "left_semi")


def top_per_snapshot(rows: DataFrame, col: str, n: int = 10, desc: bool = True, where: Column | None = None,
                     name: str = "rank") -> DataFrame:
    """Top-n rows of each snapshot by ``col`` (NULLs dropped, ties by
    symbol); ``where`` pre-filters (e.g. top-200 liquidity only)."""
    r = rows.where(F.col(col).isNotNull())
    if where is not None:
        r = r.where(where)
    o = F.col(col).desc() if desc else F.col(col).asc()
    w = Window.partitionBy("snapshot_id").orderBy(o, F.col("symbol"))
    return r.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def indicator_stats(rows: DataFrame, cols: Sequence[str], by: Sequence[str] = ("snapshot_id",)) -> DataFrame:
    """Min / max / mean / median per indicator, via unpivot + one aggregate."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = rows.selectExpr(*[f"`{b}`" for b in by], f"stack({len(cols)}, {stack}) AS (indicator, value)")
    return long.groupBy(*by, "indicator").agg(
        F.count("value").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.avg("value").alias("mean"), F.percentile("value", 0.5).alias("median"))


def market_cap_leaders(caps: DataFrame, n: int = 20) -> DataFrame:
    """Latest market cap per symbol, largest first, in billions."""
    last = caps.groupBy("symbol").agg(F.max_by("market_cap", "ts").alias("market_cap"))
    return (last.where(F.col("market_cap").isNotNull())
            .select("symbol", (F.col("market_cap") / 1e9).alias("market_cap_bn"))
            .orderBy(F.col("market_cap_bn").desc(), "symbol").limit(n))
