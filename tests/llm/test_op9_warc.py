import gzip
import os

from tests.llm.conftest import same_rows
from tidemark.llm import op9_warc as op


def files(path):
    top = path.replace("file://", "").replace("file:", "")
    return {n: open(f"{top}/{n}", "rb").read() for n in sorted(os.listdir(top)) if n.endswith(".warc.gz")}


def test_query_against_sql(spark):
    from tests.conftest import SF

    assert same_rows(op.op9_warc(spark, SF), SF, op.SQL)


def test_files_are_the_same_on_every_run(spark, tmp_path):
    from tests.conftest import SF

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    a = op.write_warc(pages, f"file://{tmp_path}/a", shard_bytes=40_000, file_bytes=6_000)
    op.write_warc(pages.repartition(7), f"file://{tmp_path}/b", shard_bytes=40_000, file_bytes=6_000)
    one, two = files(f"{tmp_path}/a"), files(f"{tmp_path}/b")
    assert one == two and len(one) > 5 and not os.path.exists(f"{tmp_path}/a/tmp")
    assert sorted(one) == sorted(r.name for r in a.collect()) and sum(r.records for r in a.collect()) == pages.count()
    text = gzip.decompress(one[sorted(one)[0]])
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"WARC-Block-Digest: sha1:" in text


def test_odd_rows(spark, tmp_path):
    rows = [(3, "u", "same", 1), (1, None, "same", 1), (1, "v", "same", 1), (2, "u\r\nX: y", "\r\n\r\nWARC/1.1 ü😀", 1), (None, "n", "same", None), (None, None, None, None),
            (7, "e", "", 1), (8, "l", "x" * 3_000_000, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    m = op.write_warc(df, f"file://{tmp_path}/odd")
    got = op.read_warc(m, f"file://{tmp_path}/odd", with_payload=True).collect()
    assert len(got) == len(rows) and all(r.digest_ok for r in got)
    odd = len("\r\n\r\nWARC/1.1 ü😀".encode())
    assert sorted(((r.key or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=repr) == sorted(
        [(0, "revisit", 1, 4), (0, "revisit", 7, 0), (1, "response", None, 4), (1, "revisit", 1, 4), (2, "response", None, odd),
         (3, "revisit", 1, 4), (7, "response", None, 0), (8, "response", None, 3_000_000)], key=repr)
    assert {r.payload for r in got if r.record_type == "response"} == {b"same", "\r\n\r\nWARC/1.1 ü😀".encode(), b"", b"x" * 3_000_000}
    least = op.write_warc(df, f"file://{tmp_path}/least", min_revisit_bytes=5)
    assert {r.record_type for r in op.read_warc(least, f"file://{tmp_path}/least").collect()} == {"response"}
    empty = op.write_warc(df.limit(0), f"file://{tmp_path}/none")
    assert op.read_warc(empty, f"file://{tmp_path}/none").count() == 0


def test_a_write_cut_off_before_the_renames_can_be_finished(spark, tmp_path, monkeypatch):
    from tests.conftest import SF

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    path = f"file://{tmp_path}/cut"
    finish = op.finish_warc

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(op, "finish_warc", lost)
    try:
        op.write_warc(pages, path, shard_bytes=40_000)
        raise AssertionError
    except RuntimeError:
        monkeypatch.undo()
    assert not os.path.exists(f"{tmp_path}/cut/manifest") and not files(path)
    for _ in range(2):
        m = finish(spark, path)
        assert op.read_warc(m, path).count() == pages.count() and sorted(files(path)) == sorted(r.name for r in m.collect())


def test_many_rows_under_one_key(spark, tmp_path):
    """A third of the rows has one key, another part none."""
    rows = [(None if i % 5 == 0 else 4 if i % 3 == 0 else i, f"u{i}", f"text {i % 50} " * 20) for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    m = op.write_warc(df, f"file://{tmp_path}/hot", shard_bytes=5_000)
    got = op.read_warc(m, f"file://{tmp_path}/hot").collect()
    assert len(got) == 600 and all(r.digest_ok for r in got)
