"""Registered queries: time (T*), projections (P*), sources (S*),
aggregations (A*), snapshots (N*) and categorical distributions (D8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import sqlsrc
from tidemark.catalog.common import bars_all, prep
from tidemark.functions import clean as C
from tidemark.functions import timeutil as TU
from tidemark.operators import bars as BR
from tidemark.operators import snapshots as N
from tidemark.operators import stats as S
from tidemark.sources import adapters as A
from tidemark.sources import io as IO
from tidemark.schemas import INTERVAL_MS

QUERIES, SQL = {}, {}
K = ["exchange", "symbol", "interval"]
KS = "exchange, symbol, interval"
rs = sqlsrc.rnd
SYD = "timezone('Australia/Sydney', make_timestamp({x} * 1000) AT TIME ZONE 'UTC')"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def rnd(df, cols, n=6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) for c in cols})


def syd(x):
    return SYD.format(x=x)


def alerts(spark, sf):
    prep(spark)
    return A.alerts(spark, sf)


# ------------------------------------------------------------------- T1-T10

def t1_t4_time_columns(spark, sf):
    a = TU.add_local_time(alerts(spark, sf).select("id", "ts"), "ts", "ts")
    return a.select("id", "ts_dt_utc", "ts_dt_syd", TU.hour_of_day("ts_dt_utc").alias("hour_utc"),
                    TU.hour_of_day("ts_dt_syd").alias("hour_syd"), TU.weekday_short("ts_dt_syd").alias("dow_syd"),
                    TU.weekday_long("ts_dt_syd").alias("dow_syd_long"))


SQL["t1_t4_time_columns"] = f"""SELECT id, make_timestamp(ts * 1000) AS ts_dt_utc, {syd('ts')} AS ts_dt_syd,
  CAST(hour(make_timestamp(ts * 1000)) AS INTEGER) AS hour_utc, CAST(hour({syd('ts')}) AS INTEGER) AS hour_syd,
  strftime({syd('ts')}, '%a') AS dow_syd, strftime({syd('ts')}, '%A') AS dow_syd_long FROM ({sqlsrc.alerts()})"""


def t5_interval_ms(spark, sf):
    """Interval label -> ms over the alert timeframes and event types (unknown -> NULL)."""
    a = alerts(spark, sf)
    labels = a.select(F.col("source_tf").alias("label")).unionByName(a.select(F.col("reason").alias("label")))
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumn("interval_ms", TU.interval_ms("label"))


SQL["t5_interval_ms"] = f"""WITH a AS ({sqlsrc.alerts()}),
l AS (SELECT source_tf AS label FROM a UNION ALL SELECT reason AS label FROM a)
SELECT label, count(*) AS n, {sqlsrc.interval_case('label')} AS interval_ms FROM l GROUP BY label"""


def t6_t7_sessions(spark, sf):
    a = alerts(spark, sf).select("id", TU.ms_to_utc("ts").alias("t"))
    f = TU.session_flags("t")
    return a.select("id", TU.in_hours("t", 8, 16).alias("in_hours_8_16"), f["in_asian"].alias("in_asian"),
                    f["in_american"].alias("in_american"), TU.session_label("t").alias("session"))


_H = "hour(make_timestamp(ts * 1000))"
SQL["t6_t7_sessions"] = f"""SELECT id, {_H} BETWEEN 8 AND 16 AS in_hours_8_16,
  ({_H} >= 22 OR {_H} < 9) AS in_asian, ({_H} >= 13 AND {_H} < 21) AS in_american,
  CASE WHEN ({_H} >= 22 OR {_H} < 9) THEN 'Asian' WHEN ({_H} >= 13 AND {_H} < 21) THEN 'American' ELSE 'Other' END AS session
FROM ({sqlsrc.alerts()})"""

T_TRAIN, T_VALID = 978_307_200_000, 1_704_931_200_000  # 2001-01-01, 2024-01-11 UTC


def t8_time_split(spark, sf):
    b = bars_all(spark, sf)
    return b.select(*K, "open_time", TU.time_split("open_time", T_TRAIN, T_VALID).alias("split"))


SQL["t8_time_split"] = f"""SELECT {KS}, open_time, CASE WHEN open_time < {T_TRAIN} THEN 'train'
  WHEN open_time < {T_VALID} THEN 'valid' ELSE 'test' END AS split FROM ({sqlsrc.bars_all()})"""


def t9_resample_bars(spark, sf):
    prep(spark)
    h = A.bars_events(spark, sf, "1h").unionByName(A.bars_events(spark, sf, "15m"))  # two source intervals, never added up
    return BR.resample_bars(h, "4h").unionByName(BR.resample_bars(h, "1d"))


def _resample_sql(to, source="1h"):
    ms = INTERVAL_MS[to]
    return f"""SELECT '{source}' AS source_interval, exchange, symbol, '{to}' AS interval, open_time - open_time % {ms} AS open_time,
  open_time - open_time % {ms} + {ms - 1} AS close_time, first(open ORDER BY open_time) AS open, max(high) AS high,
  min(low) AS low, last(close ORDER BY open_time) AS close, sum(volume) AS volume, count(*) AS n_bars
FROM ({sqlsrc.bars_events(source)}) GROUP BY exchange, symbol, open_time - open_time % {ms}"""


SQL["t9_resample_bars"] = " UNION ALL ".join(f"({_resample_sql(to, source)})" for to in ("4h", "1d") for source in ("1h", "15m"))


def t10_bars_from_ticks(spark, sf):
    prep(spark)
    return A.bars_events(spark, sf, "15m")


SQL["t10_bars_from_ticks"] = sqlsrc.bars_events("15m")


# --------------------------------------------------------------------- P1-P9

def p1_silver_ohlc(spark, sf):
    return C.silver_ohlc(bars_all(spark, sf))


SQL["p1_silver_ohlc"] = f"""SELECT {KS}, open_time, close_time, make_timestamp(open_time * 1000) AS open_ts,
  open, high, low, close, volume FROM ({sqlsrc.bars_all()})"""


def p2_silver_plans(spark, sf):
    prep(spark)
    return C.silver_plans(A.trade_plans(spark, sf))


SQL["p2_silver_plans"] = f"""SELECT id AS plan_id, alert_id, ts AS plan_ts, exchange, symbol, upper(side) AS side,
  entry_type, entry_price, stop_loss, tp1, tp2, tp3, atr, atr_mult, risk_per_unit, rr_tp1, rr_tp2, rr_tp3, swing_ref
FROM ({sqlsrc.trade_plans()})"""


def p3_numeric_coerce(spark, sf):
    prep(spark)
    o = A.table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("price_txt"),
                                            F.col("o_orderpriority").alias("prio_txt"))
    return C.numeric_coerce(o, ["price_txt", "prio_txt"])


SQL["p3_numeric_coerce"] = """SELECT o_orderkey, TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS price_txt,
  TRY_CAST(o_orderpriority AS DOUBLE) AS prio_txt FROM orders"""


def p4_p5_filters(spark, sf):
    b = C.where_in(C.where_eq(bars_all(spark, sf), exchange="EVT", symbol=None), "interval", ["1h", "4h"])
    return b.select(*K, "open_time")


SQL["p4_p5_filters"] = f"SELECT {KS}, open_time FROM ({sqlsrc.bars_all()}) WHERE exchange = 'EVT' AND interval IN ('1h', '4h')"


def p6_plan_timeframe(spark, sf):
    prep(spark)
    p = C.silver_plans(A.trade_plans(spark, sf)).select("plan_id", "alert_id")
    a = C.silver_alerts(A.alerts(spark, sf)).where(F.col("signal") == "BUY")  # SELL alerts missing -> default
    return C.with_plan_timeframe(p, a, "15m").select("plan_id", "tf")


SQL["p6_plan_timeframe"] = f"""WITH a AS (SELECT id, source_tf FROM ({sqlsrc.alerts()}) WHERE upper(signal) = 'BUY')
SELECT p.id AS plan_id, coalesce(a.source_tf, '15m') AS tf FROM ({sqlsrc.trade_plans()}) p LEFT JOIN a ON a.id = p.alert_id"""


def p7_distinct_symbols(spark, sf):
    return C.distinct_symbols(bars_all(spark, sf))


SQL["p7_distinct_symbols"] = f"SELECT DISTINCT symbol FROM ({sqlsrc.bars_all()})"


def a10_null_groups(spark, sf):
    """Exact quantiles per group where NULL is a group and one value is very frequent."""
    prep(spark)
    d = A.table(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") > 1, F.col("l_returnflag")).alias("grp"),
                                              F.when(F.col("l_quantity") < 25, F.lit(24.0)).otherwise(F.col("l_quantity").cast("double")).alias("x"))
    return rnd(S.exact_quantiles(d, ["grp"], "x", [0.1, 0.5, 0.9]), ["q10", "q50", "q90"])


SQL["a10_null_groups"] = f"""WITH d AS (SELECT CASE WHEN l_linenumber > 1 THEN l_returnflag END AS grp,
  CASE WHEN l_quantity < 25 THEN 24.0 ELSE l_quantity END::DOUBLE AS x FROM lineitem)
SELECT grp, {rs('quantile_cont(x, 0.1)')} AS q10, {rs('quantile_cont(x, 0.5)')} AS q50, {rs('quantile_cont(x, 0.9)')} AS q90 FROM d GROUP BY grp"""


def p8_optional_columns(spark, sf):
    from tidemark.schemas import SNAPSHOT_ROW
    prep(spark)
    r = A.snapshot_rows_source(spark, sf).select("symbol", "last_price")
    return C.optional_columns(r, SNAPSHOT_ROW)


def _p8_sql():
    from tidemark.schemas import SNAPSHOT_ROW
    return "SELECT symbol, last_price, " + ", ".join(f"NULL AS {f.name}" for f in SNAPSHOT_ROW.fields if f.name not in ("symbol", "last_price")) + f" FROM ({sqlsrc.snapshot_rows()})"


SQL["p8_optional_columns"] = _p8_sql()


def p9_safe_ratio(spark, sf):
    b = bars_all(spark, sf)
    return rnd(b.select(*K, "open_time", C.safe_ratio(F.col("close") - F.col("open"), F.col("high") - F.col("low"))
                        .alias("body_frac")), ["body_frac"])


SQL["p9_safe_ratio"] = f"""SELECT {KS}, open_time, {rs('CASE WHEN high - low <> 0 THEN (close - open) / (high - low) END')} AS body_frac
FROM ({sqlsrc.bars_all()})"""


# --------------------------------------------------------------------- S*

def s1_read_table(spark, sf):
    from pyspark.sql import types as T
    prep(spark)
    sch = T.StructType([T.StructField("l_returnflag", T.StringType()), T.StructField("l_quantity", T.DoubleType())])
    d = IO.read_table(spark, f"{sf}/lineitem.parquet", sch)
    return d.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


SQL["s1_read_table"] = "SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY 1"


def s2_table_columns(spark, sf):
    prep(spark)
    return IO.column_fill(A.table(spark, sf, "orders"), primary_key=["o_orderkey"])


_ORDERS = [("o_orderkey", "bigint", 1), ("o_custkey", "bigint", 0), ("o_orderstatus", "string", 0), ("o_totalprice", "double", 0),
           ("o_orderdate", "timestamp_ntz", 0), ("o_orderpriority", "string", 0)]
SQL["s2_table_columns"] = " UNION ALL ".join(
    f"SELECT '{c}' AS name, '{t}' AS type, FALSE AS not_null, {k} AS pk, count(*) AS n_rows, count({c}) AS n_values FROM orders" for c, t, k in _ORDERS)


def s11_upsert_merge(spark, sf):
    """Open orders get a repriced source row, 'P' orders are re-keyed as new
    rows; merged = target rows not in the source + all source rows."""
    prep(spark)
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    src = (o.where(F.col("o_orderstatus").isin("O", "P"))
           .withColumn("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey") + 1_000_000_000)
                       .otherwise(F.col("o_orderkey")))
           .withColumn("o_totalprice", F.round(F.col("o_totalprice") * 1.1, 2)))
    return IO.merge_rows(o, src, ["o_orderkey"])


SQL["s11_upsert_merge"] = f"""WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
s AS (SELECT CASE WHEN o_orderstatus = 'P' THEN o_orderkey + 1000000000 ELSE o_orderkey END AS o_orderkey,
        o_custkey, o_orderstatus, {rs('o_totalprice * 1.1::DOUBLE', 2)} AS o_totalprice FROM o WHERE o_orderstatus IN ('O', 'P'))
SELECT * FROM o ANTI JOIN s USING (o_orderkey) UNION ALL SELECT * FROM s"""


def s13_row_counts(spark, sf):
    prep(spark)
    return IO.row_counts({t: A.table(spark, sf, t) for t in TABLES})


SQL["s13_row_counts"] = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n FROM {t}" for t in TABLES)


def s14_preview_ingest(spark, sf):
    prep(spark)
    return IO.preview_ingest({t: A.table(spark, sf, t) for t in ("orders", "lineitem", "events")})


def _ddl(table, cols):
    return (f"SELECT '{table}' AS \"table\", 'CREATE TABLE IF NOT EXISTS bronze.{table} ({cols}) USING parquet' AS ddl, count(*) AS n FROM {table}")


SQL["s14_preview_ingest"] = " UNION ALL ".join([
    _ddl("events", "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"),
    _ddl("lineitem", "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
                     "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    _ddl("orders", "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")])


def s15_latest_rows(spark, sf):
    prep(spark)
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return IO.latest_rows(o, 10, "o_orderkey", o_orderstatus="F")


SQL["s15_latest_rows"] = """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
WHERE o_orderstatus = 'F' ORDER BY o_orderkey DESC LIMIT 10"""


# --------------------------------------------------------------------- A*

def a1_value_counts(spark, sf):
    return S.value_counts(alerts(spark, sf), ["signal", "source_tf", "setup_grade"], 20)


SQL["a1_value_counts"] = f"""SELECT signal, source_tf, setup_grade, count(*) AS count FROM ({sqlsrc.alerts()})
GROUP BY ALL ORDER BY count DESC, signal, source_tf, setup_grade LIMIT 20"""


def a2_bars_summary(spark, sf):
    return rnd(S.bars_summary(bars_all(spark, sf)), ["avg_volume"])


SQL["a2_bars_summary"] = f"""SELECT {KS}, count(*) AS n_bars, min(close_time) AS first_close_time,
  max(close_time) AS last_close_time, min(close) AS min_close, max(close) AS max_close, {rs('avg(volume)')} AS avg_volume
FROM ({sqlsrc.bars_all()}) GROUP BY ALL"""


def a3_plan_summary(spark, sf):
    prep(spark)
    return rnd(S.plan_summary(A.trade_plans(spark, sf)), ["avg_rr1", "avg_rr2", "avg_rr3", "avg_atr"])


SQL["a3_plan_summary"] = f"""SELECT side, entry_type, count(*) AS n, {rs('avg(rr_tp1)')} AS avg_rr1,
  {rs('avg(rr_tp2)')} AS avg_rr2, {rs('avg(rr_tp3)')} AS avg_rr3, {rs('avg(atr)')} AS avg_atr
FROM ({sqlsrc.trade_plans()}) GROUP BY ALL"""


def a4_top_symbols(spark, sf):
    prep(spark)
    return rnd(S.top_symbols(A.trade_plans(spark, sf), 20), ["avg_rr1"])


SQL["a4_top_symbols"] = f"""SELECT symbol, count(*) AS n_plans, {rs('avg(rr_tp1)')} AS avg_rr1
FROM ({sqlsrc.trade_plans()}) WHERE rr_tp1 IS NOT NULL GROUP BY symbol ORDER BY n_plans DESC, symbol LIMIT 20"""

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def a5_numeric_profile(spark, sf):
    prep(spark)
    li = A.table(spark, sf, "lineitem")
    return rnd(S.numeric_profile(li, LI_NUM), ["min", "max", "mean"])


SQL["a5_numeric_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {rs(f'min({c})')} AS min, {rs(f'max({c})')} AS max, {rs(f'avg({c})')} AS mean "
    f"FROM lineitem" for c in LI_NUM)

P_NAMES = ["p1", "p5", "p50", "p95", "p99"]


def a6_describe(spark, sf):
    prep(spark)
    o = A.table(spark, sf, "orders")
    return rnd(S.describe(o, ["o_totalprice"]), ["count", "mean", "std", *P_NAMES])


SQL["a6_describe"] = f"""SELECT 'o_totalprice' AS "column", CAST(count(o_totalprice) AS DOUBLE) AS count,
  {rs('avg(o_totalprice)')} AS mean, {rs('stddev_samp(o_totalprice)')} AS std,
  {', '.join(f"{rs(f'quantile_cont(o_totalprice, {p})')} AS {n}" for p, n in zip((0.01, 0.05, 0.5, 0.95, 0.99), P_NAMES))}
FROM orders"""


def a7_null_fraction(spark, sf):
    prep(spark)
    return rnd(S.null_fraction(A.trade_plans(spark, sf)), ["null_frac"])


_PLAN_COLS = ["id", "alert_id", "ts", "exchange", "symbol", "side", "entry_type", "entry_price", "stop_loss", "tp1",
              "tp2", "tp3", "atr", "atr_mult", "swing_ref", "risk_per_unit", "rr_tp1", "rr_tp2", "rr_tp3", "plan_json"]
SQL["a7_null_fraction"] = f"WITH p AS ({sqlsrc.trade_plans()}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {rs(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)')} AS null_frac FROM p"
    for c in _PLAN_COLS)


def a15_weekday_hour(spark, sf):
    a = TU.add_local_time(alerts(spark, sf), "ts", "ts")
    return S.weekday_hour_counts(a, "ts_dt_syd")


SQL["a15_weekday_hour"] = f"""SELECT strftime({syd('ts')}, '%a') AS dow, CAST(hour({syd('ts')}) AS INTEGER) AS hour,
  count(*) AS n FROM ({sqlsrc.alerts()}) GROUP BY 1, 2"""


def _snap_rows(spark, sf):
    prep(spark)
    return N.snapshot_rows(A.snapshot_cache(spark, sf))


SNAP_OK = f"(SELECT * FROM ({sqlsrc.snapshot_rows()}) WHERE snapshot_id % 5 <> 4)"


def a16_tag_frequency(spark, sf):
    return S.tag_frequency(_snap_rows(spark, sf), "sector_tags")


SQL["a16_tag_frequency"] = f"""SELECT tag, count(*) AS count FROM (SELECT unnest(sector_tags) AS tag FROM {SNAP_OK})
GROUP BY tag ORDER BY count DESC, tag"""


def a17_json_keys(spark, sf):
    prep(spark)
    return S.json_keys_seen(A.table(spark, sf, "events"), "props")


SQL["a17_json_keys"] = "SELECT unnest(json_keys(props)) AS key, count(*) AS n_docs FROM events GROUP BY 1"


# --------------------------------------------------------------------- N*

SNAP_COLS = ["last_price", "market_cap", "change_60m", "change_15m", "vol_1m", "rsi_14", "momentum_score",
             "open_interest", "funding_rate"]


def n3_snapshot_rows(spark, sf):
    r = _snap_rows(spark, sf)
    return r.select("snapshot_id", "snapshot_exchange", "snapshot_ts", "symbol", "exchange", "liquidity_rank",
                    "liquidity_top200", "signal_strength", "mtf_summary", "sector_tags", *SNAP_COLS)


SQL["n3_snapshot_rows"] = f"""SELECT snapshot_id, snap_exchange AS snapshot_exchange, snap_ts AS snapshot_ts, symbol,
  exchange, liquidity_rank, liquidity_top200, signal_strength, mtf_summary, sector_tags, {', '.join(SNAP_COLS)}
FROM {SNAP_OK}"""


def n4_latest_snapshot(spark, sf):
    prep(spark)
    s = A.snapshot_cache(spark, sf)
    return N.latest_snapshot(s, per_exchange=True).select("id", "exchange", "ts")


SQL["n4_latest_snapshot"] = f"""SELECT id, exchange, ts FROM (SELECT DISTINCT snapshot_id AS id, snap_exchange AS exchange,
  snap_ts AS ts FROM ({sqlsrc.snapshot_rows()})) QUALIFY row_number() OVER (PARTITION BY exchange ORDER BY ts DESC, id DESC) = 1"""


def n5_top_market_cap(spark, sf):
    r = _snap_rows(spark, sf)
    a = N.top_per_snapshot(r, "market_cap", 10).select("snapshot_id", "symbol", "market_cap", "rank")
    b = N.top_per_snapshot(r, "liquidity_rank", 10, desc=False, where=F.col("liquidity_top200"), name="liq_rank")
    return a.withColumn("list", F.lit("market_cap")).unionByName(
        b.select("snapshot_id", "symbol", "market_cap", F.col("liq_rank").alias("rank")).withColumn("list", F.lit("liquidity")))


SQL["n5_top_market_cap"] = f"""SELECT snapshot_id, symbol, market_cap, rank, 'market_cap' AS list FROM (
  SELECT *, row_number() OVER (PARTITION BY snapshot_id ORDER BY market_cap DESC, symbol) AS rank FROM {SNAP_OK}
  WHERE market_cap IS NOT NULL) WHERE rank <= 10
UNION ALL
SELECT snapshot_id, symbol, market_cap, rank, 'liquidity' AS list FROM (
  SELECT *, row_number() OVER (PARTITION BY snapshot_id ORDER BY liquidity_rank, symbol) AS rank FROM {SNAP_OK}
  WHERE liquidity_rank IS NOT NULL AND liquidity_top200) WHERE rank <= 10"""


def n6_gainers_losers(spark, sf):
    r = _snap_rows(spark, sf)
    g = N.top_per_snapshot(r, "change_60m", 5, desc=True).withColumn("side", F.lit("gainer"))
    lo = N.top_per_snapshot(r, "change_60m", 5, desc=False).withColumn("side", F.lit("loser"))
    return g.unionByName(lo).select("snapshot_id", "side", "rank", "symbol", "change_60m")


SQL["n6_gainers_losers"] = f"""SELECT snapshot_id, 'gainer' AS side, rank, symbol, change_60m FROM (
  SELECT *, row_number() OVER (PARTITION BY snapshot_id ORDER BY change_60m DESC, symbol) AS rank FROM {SNAP_OK}
  WHERE change_60m IS NOT NULL) WHERE rank <= 5
UNION ALL
SELECT snapshot_id, 'loser' AS side, rank, symbol, change_60m FROM (
  SELECT *, row_number() OVER (PARTITION BY snapshot_id ORDER BY change_60m ASC, symbol) AS rank FROM {SNAP_OK}
  WHERE change_60m IS NOT NULL) WHERE rank <= 5"""

IND = ["rsi_14", "momentum_score", "change_60m", "funding_rate"]


def n7_indicator_stats(spark, sf):
    s = N.indicator_stats(_snap_rows(spark, sf), IND)
    return rnd(s, ["min", "max", "mean", "median"])


SQL["n7_indicator_stats"] = " UNION ALL ".join(
    f"SELECT snapshot_id, '{c}' AS indicator, count({c}) AS n, {rs(f'min({c})')} AS min, {rs(f'max({c})')} AS max, "
    f"{rs(f'avg({c})')} AS mean, {rs(f'quantile_cont({c}, 0.5)')} AS median FROM {SNAP_OK} GROUP BY snapshot_id"
    for c in IND)


def n8_signal_counts(spark, sf):
    r = _snap_rows(spark, sf)
    a = S.value_counts(r, "signal_strength").select(F.lit("signal_strength").alias("field"),
                                                    F.col("signal_strength").alias("value"), "count")
    b = S.value_counts(r, "mtf_summary").select(F.lit("mtf_summary").alias("field"), F.col("mtf_summary").alias("value"),
                                                "count")
    c = S.value_counts(r, "exchange").select(F.lit("exchange").alias("field"), F.col("exchange").alias("value"), "count")
    return a.unionByName(b).unionByName(c)


SQL["n8_signal_counts"] = " UNION ALL ".join(
    f"SELECT '{c}' AS field, {c} AS value, count(*) AS count FROM {SNAP_OK} GROUP BY {c}"
    for c in ("signal_strength", "mtf_summary", "exchange"))


def n9_market_cap_leaders(spark, sf):
    prep(spark)
    return rnd(N.market_cap_leaders(A.market_caps(spark, sf), 20), ["market_cap_bn"])


SQL["n9_market_cap_leaders"] = f"""SELECT symbol, {rs('market_cap / 1e9')} AS market_cap_bn FROM (
  SELECT symbol, arg_max(market_cap, ts) AS market_cap FROM ({sqlsrc.market_caps()}) GROUP BY symbol)
WHERE market_cap IS NOT NULL ORDER BY market_cap DESC, symbol LIMIT 20"""


def d8_categorical(spark, sf):
    prep(spark)
    p = A.trade_plans(spark, sf)
    parts = [S.value_counts(p, c, 20).select(F.lit(c).alias("field"), F.col(c).alias("value"), "count")
             for c in ("exchange", "side", "entry_type", "swing_ref")]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


SQL["d8_categorical"] = " UNION ALL ".join(
    f"(SELECT '{c}' AS field, {c} AS value, count(*) AS count FROM ({sqlsrc.trade_plans()}) GROUP BY {c} "
    f"ORDER BY count DESC, {c} LIMIT 20)" for c in ("exchange", "side", "entry_type", "swing_ref"))


for _n, _f in list(globals().items()):
    if callable(_f) and _n[:1] in ("t", "p", "s", "a", "n", "d") and _n[1:2].isdigit():
        QUERIES[_n] = _f
