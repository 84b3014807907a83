"""WARC archives: a deterministic sharded writer and a reader.

Records are ordered by (key, url, payload digest).  Shards are cut from that order by
running payload bytes, so they do not depend on the cluster's partitioning; one task
writes a shard, rolls to a new file once the compressed size passes ``file_bytes``,
and regenerates every header and digest from the payload.  A task writes under an
attempt-unique temporary name and reports its files in a manifest, a Parquet table that Spark commits;
only then are the files of the manifest renamed to their final names (shard and number).
Files of failed or repeated attempts are never in the manifest and are deleted.  The reader opens the manifest's files only.

Of records with equal payloads of at least ``min_revisit_bytes`` bytes that with the smallest key is a
``response``, others are ``revisit`` records without a body that refer to it; smaller ones are all responses.

Nulls and ties: a null payload is empty, a null url is written as an empty target; records with a null key
come first in the order, and are never what a revisit refers to if another holds the payload; rows that repeat key
and payload all become records (the response is the first, the repeats revisit the same key); an empty
table writes an empty manifest; other columns are ignored.
A record must fit one task's memory; nothing else is held whole.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, partitions, scratch_path, table

SHARD_BYTES = 64 << 20
FILE_BYTES = 16 << 20
WARC_DATE = "2020-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard long, number int, temp string, name string, records long, bytes long"


def b32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: int | None, digest: str) -> str:
    """The same id on every run: derived from key and payload."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{digest}')}>"


def build_record(key: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None, date: str = WARC_DATE) -> bytes:
    """One WARC 1.1 record; a revisit has the HTTP header but no body."""
    digest = b32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    clean = "".join(c for c in (url or "") if c not in "\r\n")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(key, digest)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {clean}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{b32_sha1(block)}"]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
        head += [f"X-Refers-To-Key: {refers_to}"] if refers_to is not None else []
    head += [f"X-Key: {key}"] if key is not None else []
    head += [f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def _records(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    return pages.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"),
                        F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))


def _shard_starts(meta: DataFrame, shard_bytes: int) -> DataFrame:
    """(shard, key) for the first key of every shard.  Running bytes by a range
    partitioning of keys and sizes only; the sums do not depend on where it cuts."""
    n = partitions(meta)
    by_key = meta.groupBy("key").agg(F.sum(F.col("bytes") + 400).alias("bytes"))
    parts = materialize(by_key.repartitionByRange(n, F.col("key").asc_nulls_first())
                        .sortWithinPartitions(F.col("key").asc_nulls_first())
                        .withColumn("part", F.spark_partition_id()), "warc-keys")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.sum("bytes").alias("b")).select(
        "part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("offset"))  # one row per partition
    inside = Window.partitionBy("part").orderBy(F.col("key").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("bytes").over(inside), F.lit(0)) + F.col("offset")
    runs = parts.join(F.broadcast(offsets), "part").select("key", F.floor(at / F.lit(shard_bytes)).alias("shard"))
    return runs.groupBy("shard").agg(F.min("key").alias("key"), F.max(F.col("key").isNull()).alias("has_null"))


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
               min_revisit_bytes: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records under ``path`` (a folder all executors share) and return the manifest."""
    spark = pages.sparkSession
    records = _records(pages, key, url, payload)
    meta = materialize(records.select("key", F.length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1")), "warc-meta")
    # The first key of every shard: one number per shard of shard_bytes, so small at any input size.
    starts = sorted(r["key"] for r in _shard_starts(meta, shard_bytes).collect() if r["key"] is not None)[1:]

    firsts = (meta.where(F.col("bytes") >= min_revisit_bytes).groupBy("sha1")
              .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    # Rows whose payload occurs again carry the decision to the shard that writes them.
    decided = (meta.select("key", "sha1").distinct().join(firsts, "sha1")
               .select("key", F.lit("").alias("url"), F.unhex("sha1").alias("payload"), F.lit(0).alias("kind"), "first"))
    both = decided.unionByName(records.select("key", "url", "payload", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("first")))

    import numpy as np

    bounds = np.array(starts, dtype=np.int64)

    def to_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0)
            low = keys.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            digests = [p if k == 0 else hashlib.sha1(p).digest()
                       for p, k in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(bounds, low, side="right"), pa.int64()), pa.array(digests, pa.binary()), *b.columns],
                ["shard", "sha1", *b.schema.names])

    sharded = both.mapInArrow(to_shard, "shard long, sha1 binary, key long, url string, payload binary, kind int, first long")
    placed = (sharded.repartitionById(len(starts) + 1, F.col("shard").cast("int"))  # a shard is a partition
              .sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "sha1", "kind", "url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, base = _filesystem(path)
        out.create_dir(f"{base}/tmp", recursive=True)
        attempt, done, file, state = uuid.uuid4().hex, [], None, {}

        def close():
            file["stream"].close()
            done.append({k: file[k] for k in ("shard", "number", "temp", "name", "records", "bytes")})

        decision, written = None, set()
        number = 0
        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == 0:
                    decision = (r["key"], r["sha1"], r["first"])
                    continue
                same = (r["key"], r["sha1"])
                known = decision is not None and decision[:2] == same
                revisit = known and (decision[2] != r["key"] or state.get("last") == same)
                state["last"] = same
                data = build_record(r["key"], r["url"], r["payload"], revisit, decision[2] if revisit else None)
                if file and (file["shard"] != r["shard"] or file["bytes"] >= file_bytes):
                    number = number + 1 if file["shard"] == r["shard"] else 0
                    close()
                    file = None
                if file is None:
                    name = f"part-{r['shard']:08d}-{number:05d}.warc.gz"
                    temp = f"tmp/{attempt}-{name}"
                    file = {"shard": r["shard"], "number": number, "temp": temp, "name": name, "records": 0, "bytes": 0,
                            "stream": out.open_output_stream(f"{base}/{temp}", compression=None)}
                packer = zlib.compressobj(4, zlib.DEFLATED, 31)  # one gzip member per record
                packed = packer.compress(data) + packer.flush()
                file["stream"].write(packed)
                file["bytes"] += len(packed)
                file["records"] += 1
        if file:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema([("shard", pa.int64()), ("number", pa.int32()), ("temp", pa.string()),
                                                              ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    placed.mapInArrow(write, MANIFEST).write.parquet(f"{path}/pending")
    return finish_warc(spark, path)


def finish_warc(spark: SparkSession, path: str) -> DataFrame:
    """Give the files of a finished write their final names and publish the manifest, which comes last: a manifest under ``path`` names
    files that exist.  Also finishes a write whose driver was lost after all files were there; safe to repeat."""
    pending = spark.read.schema(MANIFEST).parquet(f"{path}/pending")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Safe to run again: a file that already has its final name stays."""
        out, base = _filesystem(path)
        for b in batches:
            for r in b.to_pylist():
                if out.get_file_info(f"{base}/{r['temp']}").type != fs.FileType.NotFound:
                    out.move(f"{base}/{r['temp']}", f"{base}/{r['name']}")
                elif out.get_file_info(f"{base}/{r['name']}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{path}/{r['name']}")
            yield b

    pending.mapInArrow(rename, MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")
    out, base = _filesystem(path)
    if out.get_file_info(f"{base}/tmp").type != fs.FileType.NotFound:
        out.delete_dir(f"{base}/tmp")  # what failed attempts left
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


READ = "key long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, digest_ok boolean"


def iter_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a .warc.gz stream, one gzip member at a time."""
    unzip, have, raw = zlib.decompressobj(31), [], b""
    while True:
        if not raw:
            raw = stream.read(1 << 20)
            if not raw:
                return
        have.append(unzip.decompress(raw))
        raw = b""
        if unzip.eof:
            raw, data = unzip.unused_data, b"".join(have)
            unzip, have = zlib.decompressobj(31), []
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield fields, rest[:int(fields["Content-Length"])]


def read_warc(manifest: DataFrame, path: str, with_payload: bool = False) -> DataFrame:
    """The records of the manifest's files; digests are recomputed from the bodies."""
    schema = READ + (", payload binary" if with_payload else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(path)
        names = [x.strip().split()[0] for x in schema.split(",")]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.binary()][:len(names)]
        for b in batches:
            for name in b.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for h, block in iter_records(stream):
                        body = block.partition(b"\r\n\r\n")[2]
                        kind, said = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:")
                        ok = kind == "revisit" or b32_sha1(body) == said
                        size = int(h["X-Payload-Length"]) if kind == "revisit" else len(body)
                        key, ref = h.get("X-Key"), h.get("X-Refers-To-Key")
                        row = (key and int(key), h["WARC-Target-URI"], kind, size, said, ref and int(ref), ok)
                        rows.append(row + ((body,) if with_payload else ()))
                        held += len(body) * with_payload + 200
                        if held > 8 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    n = max(1, manifest.count())
    return manifest.select("name").repartition(min(n, partitions(manifest)), "name").mapInArrow(read, schema)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to WARC files in the shared folder, read them back, one row per page."""
    path = scratch_path(spark, "warc")
    manifest = write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(manifest, path).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, octet_length(body)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM r
"""

QUERIES = {"op9_warc": op9_warc}
ORACLES = {"op9_warc": SQL}
