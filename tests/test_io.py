"""Upserts that touch few partitions and can be cut off; CSV files read by many tasks."""

import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.sources import io as IO


@pytest.fixture
def db(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/wh'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(spark, table):
    spark.catalog.refreshTable(table)
    return {r.id: (r.v, r.p) for r in spark.table(table).collect()}


def files(spark, table):
    return {(r.p, r.f) for r in spark.table(table).select("p", F.col("_metadata.file_name").alias("f")).distinct().collect()}


def source(spark, data):
    return spark.createDataFrame(data, "id long, v string, p string")


def test_upsert_rewrites_touched_partitions_only(spark, db):
    t = f"{db}.x"
    IO.save_result(source(spark, [(i, "old", f"p {i % 5}/é" if i % 5 else None) for i in range(50)]), t, partition_by=["p"])
    before = files(spark, t)
    # 7 moves from one partition to another, 60 is new in a new one, all of partition 4 moves away
    moved = [(i, "gone", "p 1/é") for i in range(4, 50, 5)]
    IO.upsert(spark, t, source(spark, [(7, "new", "p 3/é"), (60, "new", "p new")] + moved), ["id"])
    got, after = rows(spark, t), files(spark, t)
    want = {i: ("old", f"p {i % 5}/é" if i % 5 else None) for i in range(50)} | {7: ("new", "p 3/é"), 60: ("new", "p new")} | {i: (v, p) for i, v, p in moved}
    assert got == want
    assert {f for f in before if f[0] is None} == {f for f in after if f[0] is None}
    assert not any(p == "p 4/é" for p, _ in after) and not before & {f for f in after if f[0] is not None}
    with pytest.raises(ValueError):
        IO.upsert(spark, t, source(spark, [(1, "a", "b"), (1, "c", "d")]), ["id"])
    assert rows(spark, t) == want


def test_upsert_that_was_cut_off(spark, db, monkeypatch):
    t = f"{db}.y"
    IO.save_result(source(spark, [(i, "old", f"p{i % 3}") for i in range(9)]), t, partition_by=["p"])
    finish = IO.finish_upsert
    calls = []

    def lost(spark, table):
        calls.append(table)
        if len(calls) == 2:  # after the staging table is ready
            raise RuntimeError("driver lost")
        return finish(spark, table)

    monkeypatch.setattr(IO, "finish_upsert", lost)
    with pytest.raises(RuntimeError):
        IO.upsert(spark, t, source(spark, [(0, "new", "p1")]), ["id"])
    monkeypatch.undo()
    assert rows(spark, t)[0] == ("old", "p0")
    assert IO.finish_upsert(spark, t) and rows(spark, t)[0] == ("new", "p1") and len(rows(spark, t)) == 9
    assert not IO.finish_upsert(spark, t)
    spark.range(3).write.saveAsTable(f"{t}__staging")  # one that never got ready
    IO.upsert(spark, t, source(spark, [(1, "newer", "p1")]), ["id"])
    assert rows(spark, t)[1] == ("newer", "p1") and len(rows(spark, t)) == 9


def test_unpartitioned_upsert_and_recreate(spark, db):
    t = f"{db}.z"
    IO.save_result(source(spark, [(1, "a", "x"), (2, "b", "x")]), t)
    IO.upsert(spark, t, source(spark, [(2, "c", "y"), (3, "d", "y")]), ["id"])
    assert rows(spark, t) == {1: ("a", "x"), 2: ("c", "y"), 3: ("d", "y")}
    IO.recreate_load(spark.table(t).withColumn("n", F.col("id") + 1), t)
    assert spark.table(t).columns == ["id", "v", "p", "n"] and not spark.catalog.tableExists(f"{t}__old")


@pytest.mark.parametrize("size", [90, 1_000, 100_000])
def test_split_csv_reads_the_same_rows(spark, tmp_path, size):
    texts = ["plain", "two\nlines", 'a "quoted" word', "back\\slash", '\\"', "tab\there", "\n\n\n", "long " * 60 + "\n" + "tail " * 60, "é😀\n", None, "end\\\\", '"', '\n"\n"\n']
    df = spark.createDataFrame([(i, texts[i % len(texts)], float(i) if i % 3 else None, texts[i * 7 % len(texts)]) for i in range(91)], "id long, a string, x double, b string")
    name = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(name)
    for header in (False, True):
        path = f"{tmp_path}/{header}"
        IO.export_csv(df.repartition(2), path, header=header, sep="\t")
        want = sorted(map(repr, IO.bulk_load_csv(spark, path, df.schema, header=header).collect()))
        spark.conf.set(name, str(size))
        try:
            got = IO.load_csv_split(spark, path, df.schema, header=header)
            assert sorted(map(repr, got.collect())) == want and len(want) == 91
            if size == 90:
                assert spark.read.text(path).rdd.getNumPartitions() > 20
        finally:
            spark.conf.set(name, usual)


def test_split_size_grows_with_the_files(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 100_000)
    assert IO.split_bytes(spark, str(tmp_path), 8192) == 8192
    (tmp_path / "b").write_bytes(b"x" * 8_092_001)
    assert IO.split_bytes(spark, str(tmp_path), 8192) == 16_001
    assert IO.split_bytes(spark, str(tmp_path), 8192, tasks=2, most=1_000_000) == 1_000_000
