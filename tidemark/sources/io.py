"""Sources, sinks and table maintenance (S1-S17) on Spark's readers/writers.

There is no SQL warehouse client, no row-by-row INSERT and no local SQLite
reader here: tables are read with Spark's data sources and written with
``DataFrameWriter``.  ``MERGE INTO`` needs a table format that supports it;
on plain Parquet tables the upsert stages the merged rows of the touched
partitions and overwrites those.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import null_safe_join
from tidemark.session import cut_lineage


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
               **options) -> DataFrame:
    """Full-table scan with an explicit schema (no inference)."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def column_fill(df: DataFrame, primary_key: Sequence[str] = ()) -> DataFrame:
    """S2 with data: ``table_columns`` and how many rows hold a value in each column, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col("_n").alias("n_rows"), F.col(f"_{i}").alias("n_values")) for i, c in enumerate(df.columns)]))
    return table_columns(df, primary_key).join(counts.select(each), "name")


def table_columns(df: DataFrame, primary_key: Sequence[str] = ()) -> DataFrame:
    """Name, type, not-null and primary-key position of each column."""
    rows = [(f.name, f.dataType.simpleString(), not f.nullable,
             (list(primary_key).index(f.name) + 1) if f.name in primary_key else 0) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "name string, type string, not_null boolean, pk int")


def spark_type(decl: str | None) -> T.DataType:
    """S3: declared column type -> Spark type by affinity: *INT* -> BIGINT;
    REAL/FLOA/DOUB -> DOUBLE; CHAR/CLOB/TEXT -> STRING; BLOB -> BINARY;
    anything else (empty, NUMERIC, DECIMAL) -> STRING (typed later with
    try_cast)."""
    d = (decl or "").upper()
    if "INT" in d:
        return T.LongType()
    if any(x in d for x in ("REAL", "FLOA", "DOUB")):
        return T.DoubleType()
    if any(x in d for x in ("CHAR", "CLOB", "TEXT")):
        return T.StringType()
    if "BLOB" in d:
        return T.BinaryType()
    return T.StringType()


def schema_from_decls(cols: Sequence[tuple[str, str, bool]]) -> T.StructType:
    """StructType from (name, declared type, not_null) triples."""
    return T.StructType([T.StructField(n, spark_type(t), not nn) for n, t, nn in cols])


_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _q(name: str) -> str:
    return ".".join(p if _IDENT.match(p) else f"`{p}`" for p in name.split("."))


def create_table_ddl(name: str, schema: T.StructType, fmt: str = "parquet",
                     partition_by: Sequence[str] = ()) -> str:
    """Idempotent DDL text with NOT NULL columns."""
    cols = ", ".join(f"{_q(f.name)} {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}"
                     for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(map(_q, partition_by))})" if partition_by else ""
    return f"CREATE TABLE IF NOT EXISTS {_q(name)} ({cols}) USING {fmt}{part}"


def create_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet",
                 partition_by: Sequence[str] = ()) -> None:
    spark.sql(create_table_ddl(name, schema, fmt, partition_by))


def ensure_namespace(spark: SparkSession, ns: str, location: str | None = None) -> None:
    """CREATE SCHEMA IF NOT EXISTS (at ``location``, else under the warehouse)."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_q(ns)}" + (f" LOCATION '{location}'" if location else ""))


def export_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", mode: str = "overwrite") -> None:
    """Every field quoted, backslash escape, NULL as empty."""
    (df.write.mode(mode).option("header", header).option("sep", sep).option("quoteAll", True)
     .option("escape", "\\").option("nullValue", "").option("emptyValue", "").csv(path))


def bulk_load_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t",
                  header: bool = False) -> DataFrame:
    """Explicit columns, multi-line fields, backslash escape, '"' quote."""
    return (spark.read.schema(schema).option("sep", sep).option("header", header).option("multiLine", True)
            .option("escape", "\\").option("quote", '"').csv(path))


_ESCAPED = r"\\."


def _open_quotes(line):
    """Whether a line holds an odd number of quotes that no backslash escapes."""
    bare = F.when(F.contains(line, F.lit("\\")), F.regexp_replace(line, _ESCAPED, "")).otherwise(line)
    return F.pmod(F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit(""))), F.lit(2)) == 1


def split_bytes(spark: SparkSession, path: str, least: int, tasks: int = 512, most: int = 128 << 20) -> int:
    """A split size that reads what lies under ``path`` by about ``tasks`` tasks: fixed small splits would cost a task each, and
    ``load_csv_split`` an entry each on the driver, however large the files are."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return min(max(least, -(-size // tasks)), most)


def load_csv_split(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t", header: bool = False) -> DataFrame:
    """S7 for large files: as ``bulk_load_csv``, but a file is read by as many tasks as it has splits.

    A line starts a record if the quotes before it in its file are even.  A first scan takes the parity of every split; summed up
    per file it tells each split whether it starts inside a quoted field.  The second scan then puts lines together to records inside
    its splits; what crosses a border (at most two pieces per split) is joined from the pieces.  Both scans have to see the same splits, so the
    result must be read under the same ``spark.sql.files.maxPartitionBytes``; a split that the first did not see is an error."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    odd = lines.groupBy("file", "start").agg(F.sum(_open_quotes(F.col("value")).cast("int")).alias("q"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = odd.withColumn("inside", F.pmod(F.coalesce(F.sum("q").over(before), F.lit(0)), F.lit(2)) == 1)
    # One entry per split of the scan.
    sent = spark.sparkContext.broadcast({(r["file"], r["start"]): r["inside"] for r in inside.collect()})

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(hash of the file's path, start, piece, text): whole records (piece 0), or the end (1) and the beginning (2) of one that crosses the split's borders, or a
        split that is all inside a record (3)."""
        escaped, names = re.compile(_ESCAPED, re.S), ["file", "start", "piece", "text"]
        split, held, opened, started = None, [], False, True
        out: list[tuple] = []

        def close() -> None:
            if split is not None and held:
                out.append((*split, (2 if started else 3) if opened else 0 if started else 1, "\n".join(held)))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [(), (), (), ()]
            rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.string()))], names)
            out.clear()
            return rows

        for b in batches:
            for line, file, start in zip(*(b.column(i).to_pylist() for i in range(3))):
                if (file, start) != split:
                    close()
                    split, held = (file, start), []
                    opened = sent.value[split]
                    started = not opened  # whether the held record begins in this split
                held.append(line)
                if '"' in line and escaped.sub("", line).count('"') % 2:
                    opened = not opened
                if not opened:
                    out.append((*split, 0 if started else 1, "\n".join(held)))
                    held, started = [], True
            if len(out) > 1000:
                yield flush()
        close()
        if out:
            yield flush()

    got = lines.mapInArrow(records, "file long, start long, piece int, text string")
    whole = got.where("piece = 0").select("file", "start", "text")
    # In file order an end comes before the beginning in the same split; a beginning opens the next record.
    order = Window.partitionBy("file").orderBy("start", "piece")
    cut = got.where("piece > 0").withColumn("no", F.sum(F.when(F.col("piece") == 2, 1).otherwise(0)).over(order))
    joined = cut.groupBy("file", "no").agg(F.min("start").alias("start"), F.sort_array(F.collect_list(F.struct("start", "piece", "text"))).alias("l"))
    joined = joined.select("file", "start", F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("text"))
    rows = whole.unionByName(joined).where(F.col("text") != "")
    if header:
        rows = rows.where(~((F.col("start") == 0) & (F.col("text") == _header_text(schema, sep))))
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nullable.fields)
    return rows.select(F.from_csv("text", ddl, {"sep": sep, "escape": "\\", "quote": '"', "mode": "PERMISSIVE"}).alias("r")).select("r.*")


def _header_text(schema: T.StructType, sep: str):
    """The header line that ``export_csv`` writes."""
    return F.lit(sep.join(f'"{f.name}"' for f in schema.fields))


def append(df: DataFrame, table: str) -> None:
    """Append rows to a table (created on first write); columns are
    matched by name and the table's own layout (partitioning) is kept."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df.select(*spark.table(table).columns).write.insertInto(table)
    else:
        df.write.saveAsTable(table)


def truncate_load(df: DataFrame, table: str) -> None:
    """Replace the rows, keep the table (and its partitioning)."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.insertInto(table, overwrite=True)


def recreate_load(df: DataFrame, table: str) -> None:
    """Incompatible schema -> drop and create with the new one.  The new
    rows are written to a staging table first (``df`` may read ``table``),
    then swapped in."""
    spark = df.sparkSession
    staging = f"{table}__recreate"
    spark.sql(f"DROP TABLE IF EXISTS {_q(staging)}")
    df.write.saveAsTable(staging)
    old = f"{table}__old"
    spark.sql(f"DROP TABLE IF EXISTS {_q(old)}")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {_q(table)} RENAME TO {_q(old)}")
    spark.sql(f"ALTER TABLE {_q(staging)} RENAME TO {_q(table)}")
    spark.sql(f"DROP TABLE IF EXISTS {_q(old)}")


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """S11 (plan): matched keys take the source row (all columns), unmatched
    source rows are inserted, other target rows stay (J9 anti-join + union)."""
    if not keys:
        raise ValueError("upsert needs key columns (no primary key known)")
    src = source.select(*target.columns)
    return target.join(src.select(*keys), list(keys), "left_anti").unionByName(src)


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    dup = df.groupBy(*keys).count().where("count > 1").limit(1).count()
    if dup:
        raise ValueError(f"source has duplicate keys on {list(keys)}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


READY = "tidemark.upsert.ready"


def upsert(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str]) -> None:
    """Upsert into a Parquet table, failing on duplicate source keys.

    Only touched partitions are rewritten: those that source rows go to and those that hold a row with a source key (found under the
    range of the first key, which prunes row groups).  Their merged rows are staged, the staging table is marked ready, and then they replace the partitions;
    all other files stay.  If that is cut off, ``finish_upsert`` (which every upsert calls first) does it again from the staging
    table; a staging table that is not ready is dropped, as the live table has not been changed.  A table without partitions is one partition."""
    finish_upsert(spark, table)
    check_unique(source, keys)
    live, parts = spark.table(table), partition_columns(spark, table)
    staging, touched = f"{table}__staging", f"{table}__touched"
    if not keys:
        raise ValueError("upsert needs key columns (no primary key known)")
    src = cut_lineage(source.select(*live.columns))
    if parts:
        lo, hi = src.agg(F.min(keys[0]), F.max(keys[0])).first()
        near = live.where(F.col(keys[0]).between(lo, hi)) if lo is not None else live.limit(0)
        hit = near.join(src.select(*keys), list(keys), "left_semi").select(*parts)
        cut_lineage(hit.unionByName(src.select(*parts)).distinct()).write.saveAsTable(touched)
        old = null_safe_join(live, spark.table(touched).withColumn("_t", F.lit(True)), parts).drop("_t").select(*live.columns)
        merge_rows(old, src, keys).write.partitionBy(*parts).saveAsTable(staging)
    else:
        merge_rows(live, src, keys).write.saveAsTable(staging)
    spark.sql(f"ALTER TABLE {_q(staging)} SET TBLPROPERTIES ('{READY}' = 'true')")
    finish_upsert(spark, table)


def finish_upsert(spark: SparkSession, table: str) -> bool:
    """Publish the staging table of an upsert that was cut off after it was marked ready; drop one that was not.  Safe to repeat."""
    staging, touched = f"{table}__staging", f"{table}__touched"
    ready = False
    if spark.catalog.tableExists(staging):
        ready = any(r["key"] == READY for r in spark.sql(f"SHOW TBLPROPERTIES {_q(staging)}").collect())
    if ready:
        rows, live, parts = spark.table(staging), spark.table(table), partition_columns(spark, table)
        if parts:
            # Partitions that all rows have left: their folders, before anything is replaced.
            where = null_safe_join(live.select(*parts, F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_dir")).distinct(),
                                   spark.table(touched).withColumn("_t", F.lit(True)), parts)
            left = null_safe_join(where, rows.select(*parts).distinct().withColumn("_stays", F.lit(True)), parts, "left").where("_stays IS NULL")
            emptied = [r["_dir"] for r in left.select("_dir").distinct().collect()]
            mode = "spark.sql.sources.partitionOverwriteMode"
            usual = spark.conf.get(mode)
            spark.conf.set(mode, "dynamic")
            try:
                rows.select(*live.columns).write.insertInto(table, overwrite=True)
            finally:
                spark.conf.set(mode, usual)
            for folder in emptied:
                path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            spark.catalog.refreshTable(table)
        else:
            truncate_load(rows, table)
    for name in (staging, touched):
        spark.sql(f"DROP TABLE IF EXISTS {_q(name)}")
    return ready


def select_tables(requested: Iterable[str] | None, available: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Subset of tables; unknown names are an error, empty tables are skipped."""
    names = list(requested) if requested else sorted(available)
    unknown = [n for n in names if n not in available]
    if unknown:
        raise KeyError(f"unknown tables: {unknown}")
    return {n: available[n] for n in names if not available[n].isEmpty()}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, n) for each table as one UNION ALL job, ordered by name."""
    parts = [df.select(F.lit(n).alias("table"), F.count(F.lit(1)).alias("n")) for n, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table")


def preview_ingest(tables: Mapping[str, DataFrame], namespace: str = "bronze") -> DataFrame:
    """Planned DDL per table plus its row count; writes nothing."""
    counts = row_counts(tables)
    ddl = counts.sparkSession.createDataFrame(
        [(n, create_table_ddl(f"{namespace}.{n}", df.schema)) for n, df in sorted(tables.items())],
        "table string, ddl string")
    return ddl.join(counts, "table").orderBy("table")


def latest_rows(df: DataFrame, n: int, order_col: str, **eq) -> DataFrame:
    """The last ``n`` rows by ``order_col`` (after optional equality
    filters), returned in ascending order (TakeOrderedAndProject)."""
    for c, v in eq.items():
        if v is not None:
            df = df.where(F.col(c) == F.lit(v))
    return df.orderBy(F.col(order_col).desc()).limit(n).orderBy(order_col)


def save_result(df: DataFrame, table: str, mode: str = "append", partition_by: Sequence[str] = (),
                overwrite_schema: bool = False) -> None:
    """Append / overwrite a result table, optionally partitioned."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if overwrite_schema and mode == "overwrite":
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {_q(table)}")
    w.saveAsTable(table)


def export_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with ISO-8601 timestamps."""
    (df.write.mode(mode).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
     .option("ignoreNullFields", False).json(path))
