"""Registered queries: sinks and table maintenance round trips (S3-S10,
S12, S16, S17).  Files and tables go under the checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.catalog import sqlsrc
from tidemark.catalog.common import prep
from tidemark.session import cut_lineage
from tidemark.sources import adapters as A
from tidemark.sources import io as IO
from tidemark.streaming.streams import scratch

QUERIES, SQL = {}, {}
rs = sqlsrc.rnd

# Declared type text per Spark type, as a row-store DDL would carry them.
DECL = {"bigint": "INTEGER", "int": "INT", "double": "REAL", "string": "TEXT", "timestamp_ntz": "DATETIME",
        "timestamp": "DATETIME", "binary": "BLOB"}


def s3_s4_s5_ddl(spark, sf):
    """Declared types -> Spark types, a namespace and a table created from them,
    the orders loaded into it and read back."""
    prep(spark)
    o = A.table(spark, sf, "orders")
    decls = [(f.name, DECL.get(f.dataType.simpleString(), "NUMERIC"), False) for f in o.schema.fields]
    db = f"tm_{uuid.uuid4().hex[:8]}"
    IO.ensure_namespace(spark, db, scratch(spark, "namespace"))
    IO.create_table(spark, f"{db}.orders", IO.schema_from_decls(decls))
    target = spark.table(f"{db}.orders").schema
    IO.append(o.select(*[F.col(f.name).cast(f.dataType) for f in target.fields]), f"{db}.orders")
    back = spark.table(f"{db}.orders")
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.min("o_orderdate").alias("first_date"))


SQL["s3_s4_s5_ddl"] = """SELECT o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS keys,
  min(o_orderdate::VARCHAR) AS first_date FROM orders GROUP BY 1"""


def s6_s7_csv_roundtrip(spark, sf):
    """Plans exported as quoted, escaped, NULL-as-empty TSV and bulk-loaded
    back with an explicit schema."""
    prep(spark)
    p = A.trade_plans(spark, sf).select("id", "symbol", "side", "entry_price", "stop_loss", "plan_json")
    path = scratch(spark, "csv")
    IO.export_csv(p, path, header=False, sep="\t")
    back = IO.bulk_load_csv(spark, path, p.schema, sep="\t", header=False)
    return back.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.count("stop_loss").alias("n_stop"),
                                    F.round(F.sum("entry_price"), 2).alias("sum_entry"),
                                    F.count("plan_json").alias("n_json"))


SQL["s6_s7_csv_roundtrip"] = f"""SELECT side, count(*) AS n, count(stop_loss) AS n_stop,
  {rs('sum(entry_price)', 2)} AS sum_entry, count(plan_json) AS n_json FROM ({sqlsrc.trade_plans()}) GROUP BY side"""


def s8_s10_s16_table_ops(spark, sf):
    """Save, append, upsert, truncate-load and recreate a result table in a
    database under the checkpoint folder; the table is read back after each step."""
    prep(spark)
    db = f"tm_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch(spark, 'warehouse')}'")
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    t = f"{db}.orders_copy"
    seen = []

    def read(step):
        now = spark.table(t).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
        parts = ",".join(IO.partition_columns(spark, t))
        seen.append(cut_lineage(now.select(F.lit(step).alias("step"), F.lit(parts).alias("partitions"), "*")))

    IO.save_result(o.where("o_orderstatus = 'F'"), t, mode="overwrite", partition_by=["o_orderstatus"])
    read("save")
    IO.append(o.where("o_orderstatus = 'O'"), t)
    read("append")
    IO.upsert(spark, t, o.where("o_orderstatus = 'P' OR o_orderkey % 5 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"])
    read("upsert")
    IO.truncate_load(o, t)
    read("truncate")
    IO.recreate_load(spark.table(t).withColumn("o_bucket", F.col("o_orderkey") % 7), t)
    read("recreate")
    out = seen[0]
    for df in seen[1:]:
        out = out.unionByName(df)
    return out


SQL["s8_s10_s16_table_ops"] = f"""WITH steps AS (
SELECT 'save' AS step, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'append', o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')
UNION ALL SELECT 'upsert', o_orderstatus, o_totalprice + CASE WHEN o_orderstatus = 'P' OR o_orderkey % 5 = 0 THEN 1 ELSE 0 END FROM orders
UNION ALL SELECT 'truncate', o_orderstatus, o_totalprice FROM orders
UNION ALL SELECT 'recreate', o_orderstatus, o_totalprice FROM orders)
SELECT step, CASE WHEN step = 'recreate' THEN '' ELSE 'o_orderstatus' END AS partitions, o_orderstatus, count(*) AS n,
  {rs('sum(o_totalprice)', 2)} AS total FROM steps GROUP BY step, o_orderstatus"""


def s12_select_tables(spark, sf):
    prep(spark)
    avail = {t: A.table(spark, sf, t) for t in ("orders", "lineitem", "labels", "region")}
    return IO.row_counts(IO.select_tables(["orders", "lineitem", "region"], avail))


SQL["s12_select_tables"] = """SELECT 'lineitem' AS "table", count(*) AS n FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'region', count(*) FROM region"""


def s17_json_roundtrip(spark, sf):
    prep(spark)
    a = A.alerts(spark, sf).select("id", "signal", "price", F.timestamp_millis("ts").alias("ts_utc"))
    path = scratch(spark, "json")
    IO.export_json(a, path)
    back = spark.read.schema(a.schema).json(path)
    return back.groupBy("signal").agg(F.count(F.lit(1)).alias("n"), F.min("ts_utc").alias("first_ts"),
                                      F.round(F.sum("price"), 2).alias("sum_price"))


SQL["s17_json_roundtrip"] = f"""SELECT signal, count(*) AS n, make_timestamp(min(ts) * 1000) AS first_ts,
  {rs('sum(price)', 2)} AS sum_price FROM ({sqlsrc.alerts()}) GROUP BY signal"""



def s7_split_csv(spark, sf):
    """Plans with fields over several lines, quotes and backslashes in one file, read back by many tasks (splits of 8 KB, of large files 1 / 512 of the file)."""
    prep(spark)
    p = A.trade_plans(spark, sf).select("id", "side", "entry_price", F.concat(
        F.col("symbol"), F.lit('\n"'), F.col("side"), F.lit('"\t\\\n\n'), F.repeat(F.lit('x,"\n'), F.pmod("id", F.lit(5)).cast("int")), F.lit("end")).alias("note"))
    path = scratch(spark, "csv-split")
    IO.export_csv(p.coalesce(1), path, header=True, sep="\t")
    name = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(IO.split_bytes(spark, path, 8192)))
    try:
        return cut_lineage(IO.load_csv_split(spark, path, p.schema, header=True))
    finally:
        spark.conf.set(name, usual)


SQL["s7_split_csv"] = f"""SELECT id, side, entry_price,
  symbol || chr(10) || '"' || side || '"' || chr(9) || chr(92) || chr(10) || chr(10) || repeat('x,"' || chr(10), (id % 5)::INT) || 'end' AS note FROM ({sqlsrc.trade_plans()})"""


def s11_upsert_touched(spark, sf):
    """Orders by year, upserted: those of the last year of the table repriced, one in seven of the year before moved there.  Per year the
    rows, and whether all its files are the ones from before."""
    prep(spark)
    db = f"tm_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch(spark, 'warehouse')}'")
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("o_year"))
    t = f"{db}.orders_by_year"
    IO.save_result(o, t, mode="overwrite", partition_by=["o_year"])
    files = lambda name: cut_lineage(spark.table(t).groupBy("o_year").agg(F.array_sort(F.collect_set(F.col("_metadata.file_name"))).alias(name)))
    was = files("was")
    last = o.agg(F.max("o_year")).first()[0]
    src = o.where((F.col("o_year") == last) | ((F.col("o_year") == last - 1) & (F.col("o_orderkey") % 7 == 0)))
    IO.upsert(spark, t, src.withColumns({"o_totalprice": F.col("o_totalprice") + 1, "o_year": F.lit(last)}), ["o_orderkey"])
    now = spark.table(t).groupBy("o_year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    same = files("now").join(was, "o_year", "left").select("o_year", F.coalesce(F.col("now") == F.col("was"), F.lit(False)).alias("files_kept"))
    return now.join(same, "o_year")


SQL["s11_upsert_touched"] = f"""WITH o AS (SELECT o_orderkey, o_totalprice, year(o_orderdate) AS y, max(year(o_orderdate)) OVER () AS last FROM orders),
m AS (SELECT *, y = last OR (y = last - 1 AND o_orderkey % 7 = 0) AS hit FROM o)
SELECT CASE WHEN hit THEN last ELSE y END AS o_year, count(*) AS n, {rs('sum(CASE WHEN hit THEN o_totalprice + 1 ELSE o_totalprice END)', 2)} AS total,
  bool_and(y < last - 1) AS files_kept FROM m GROUP BY 1"""


for _n, _f in list(globals().items()):
    if callable(_f) and _n[:1] == "s" and _n[1:2].isdigit():
        QUERIES[_n] = _f
