"""Approximate nearest neighbours by cross-polytope hashing, reranked exactly.

The indexed vectors are divided into bands of near norms (quarter octaves), each searched by itself, so that a few long vectors
do not flatten the others.  In a band, largest inner product becomes smallest angle by one more coordinate, sqrt(M^2 - |x|^2) on
the indexed side (M the largest norm of the band) and 0 on the query's.  The vector, padded to a power of two, is turned by a fast pseudo-rotation (three rounds of random
signs and a Walsh-Hadamard transform) and hashed to the nearest of the signed axes; ``TABLES`` tables use their own signs.
A query probes in every band and table the occupied signed axes nearest to it, until it has probed ``probes`` of them and seen k + 1 vectors
and its share of ``MIN_CANDIDATES`` (the bucket sizes are known; a band that is probed whole needs one table).  Buckets are cut into blocks of indexed vectors and of queries; a task takes the inner products of
a query block with a candidate block of the same bucket, in double precision on the original numbers, and keeps the best of each query.

Equal vectors are one entry that carries its k + 1 smallest ids: more can never be among k results, so a vector that a
third of all rows share costs no more than any other, and each distinct query vector is searched once.

Nulls and ties: vectors that are null, zero or hold a null or non-finite component take no part, nor do rows with a null
id; ties of the score go to the smaller id; rows that repeat id and vector are one; only vectors of one length
are compared with each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, partitions, table

TABLES = 8
PROBES = 18
MIN_CANDIDATES = 20_000
SEED = 11
BLOCK = 1024
QUERY_BLOCK = 256
TOP = 20


def rotate(x: np.ndarray, table_no: int, rounds: int = 3) -> np.ndarray:
    """Pseudo-rotation of the rows of ``x`` (width a power of two)."""
    rng = np.random.default_rng([SEED, table_no, x.shape[1]])
    for _ in range(rounds):
        x = x * rng.choice(np.array([-1.0, 1.0]), x.shape[1])
        step = 1
        while step < x.shape[1]:
            y = x.reshape(len(x), -1, 2, step)
            x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(len(x), -1)
            step *= 2
    return x


def length_of(x: np.ndarray) -> float:
    """The norm of a finite vector other than zero, finite also where the squares are not."""
    m = float(np.abs(x).max())
    return min(m * math.sqrt(float(((x / m) ** 2).sum())), np.finfo(np.float64).max)


def norm_band(norm: float) -> int:
    """Quarter octave of a norm; norms near a power of two (as 1) are in the middle of one."""
    return round(4 * math.log2(norm))


def padded(vectors: np.ndarray, norm: np.ndarray, query: bool) -> np.ndarray:
    """Unit-free coordinates (by ``norm``, one per row) with the extra one, up to the next power of two."""
    n, d = vectors.shape
    out = np.zeros((n, 1 << d.bit_length()))
    out[:, :d] = vectors / norm[:, None]
    if not query:
        out[:, d] = np.sqrt(np.maximum(1.0 - (out[:, :d] ** 2).sum(axis=1), 0.0))
    return out


def signed_axes(rotated: np.ndarray) -> np.ndarray:
    """Coordinates along every signed axis: first the positive, then the negative ones."""
    return np.concatenate([rotated, -rotated], axis=1)


def bucket_key(length: int, band, table_no: int, axis):
    """22 bits of the axis, 6 of the table, 14 of the band, the rest of the length."""
    return (((np.int64(length) << np.int64(14)) + np.asarray(band, np.int64) + np.int64(6000) << np.int64(6)) + np.int64(table_no) << np.int64(22)) + np.asarray(axis, np.int64)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v, np.float64) for v in column.to_pylist()]


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(vec binary, ids array<long> (the ``keep`` smallest), asked boolean): combined per partition before the shuffle."""
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}

        def out():
            got = [(v, sorted(ids)[:keep], asked) for v, (ids, asked) in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.list_(pa.int64())),
                                               pa.array([g[2] for g in got], pa.bool_())], ["vec", "ids", "asked"])

        for b in batches:
            for i, v, asked in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if not v or any(x is None for x in v):
                    continue
                x = np.array(v, np.float64)
                if not np.isfinite(x).all() or not x.any():
                    continue
                x += 0.0  # one form of zero
                entry = held.setdefault(x.tobytes(), [set(), False])
                entry[0].add(i)
                entry[1] |= bool(asked)
                if len(entry[0]) > 8 * keep:
                    entry[0] = set(sorted(entry[0])[:keep])
            if len(held) > 50_000:
                yield out()
        if held:
            yield out()

    some = rows.mapInArrow(combine, "vec binary, ids array<long>, asked boolean")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return some.groupBy("vec").agg(ids.alias("ids"), F.max("asked").alias("asked"))


def _blocked(rows: DataFrame, size: int) -> DataFrame:
    """Blocks (key, block, nodes, lows, vecs) of at most ``size`` of the rows (key, node, low, vec); buckets are range-partitioned."""
    parts = rows.repartitionByRange(partitions(rows), "key", "node").sortWithinPartitions("key", "node")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def out():
            block = {"key": held[0]["key"], "nodes": [r["node"] for r in held], "lows": [r["low"] for r in held], "vecs": b"".join(r["vec"] for r in held)}
            held.clear()
            return pa.RecordBatch.from_pylist([block], pa.schema([("key", pa.int64()), ("nodes", pa.list_(pa.int64())),
                                                                  ("lows", pa.list_(pa.int64())), ("vecs", pa.binary())]))

        for b in batches:
            for r in b.to_pylist():
                if held and (held[0]["key"] != r["key"] or len(held) == size):
                    yield out()
                held.append(r)
        if held:
            yield out()

    return parts.mapInArrow(cut, "key long, nodes array<long>, lows array<long>, vecs binary")


def _best(keep: int):
    """The ``keep`` best of every query of a block among a block of candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                q, c = np.frombuffer(r["qvecs"], np.float64).reshape(len(r["qnodes"]), -1), np.frombuffer(r["vecs"], np.float64).reshape(len(r["nodes"]), -1)
                nodes, lows, asked = np.array(r["nodes"]), np.array(r["lows"]), np.array(r["qnodes"])
                s = q @ c.T
                k = min(keep + 4, len(nodes))  # a matrix product may round equal scores apart
                order = np.argsort(lows, kind="stable")  # ties: the stable sort below keeps smaller ids first
                s = s[:, order]
                top = np.argsort(-s, axis=1, kind="stable")[:, :k] if len(nodes) <= 4 * keep else _partial(s, k)
                at = order[top]
                score = (q[:, None, :] * c[at]).sum(axis=2)  # the same number whatever the block
                n = len(asked)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(asked, k)), pa.array(nodes[at].ravel()), pa.array(lows[at].ravel()),
                                                  pa.array(score.ravel()), pa.array(np.full(n * k, r["salt"], np.int32))], ["q", "node", "low", "score", "salt"])
    return run


def _partial(s: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest per row, ties to the smaller column."""
    floor = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    out = np.empty((len(s), k), np.int64)
    for i in range(len(s)):
        c = np.flatnonzero(s[i] >= floor[i])
        out[i] = c[np.argsort(-s[i, c], kind="stable")[:k]]
    return out


def _top(keep: int) -> Column:
    """The best distinct (score, low, node) of a group."""
    got = F.collect_set(F.struct((-F.col("score")).alias("far"), "low", "node"))
    return F.slice(F.array_sort(got), 1, keep)


def nearest(rows: DataFrame, asked: Column, k: int = TOP, id_col: str = "vec_id", vec_col: str = "embedding",
            tables: int = TABLES, probes: int = PROBES, min_candidates: int = MIN_CANDIDATES) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``asked`` holds."""
    spark = rows.sparkSession
    given = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), asked.alias("asked")).where("id IS NOT NULL")
    keep = k + 1
    nodes = materialize(distinct_vectors(given, keep).withColumn("node", F.monotonically_increasing_id())
                        .withColumn("low", F.element_at("ids", 1)), "ann-nodes")

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [length_of(x) for x in _vectors(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([norm_band(x) for x in got], pa.int32()), pa.array(got, pa.float64())], ["band", "norm"])

    # One row per quarter octave that occurs: a few thousand at most, whatever the input.
    longest = {r["band"]: r["norm"] for r in nodes.select("vec").mapInArrow(norms, "band int, norm double").groupBy("band").agg(F.max("norm").alias("norm")).collect()}

    def by_length(vecs: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for length in sorted({len(v) for v in vecs}):
            own = np.array([i for i, v in enumerate(vecs) if len(v) == length])
            yield length, own, np.array([vecs[i] for i in own])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for length, own, x in by_length(_vectors(b.column(2))):
                band = np.array([norm_band(length_of(v)) for v in x])
                x = padded(x, np.array([longest[k] for k in band.tolist()]), False)
                take = pa.array(own)
                for t in range(tables):
                    key = bucket_key(length, band, t, np.argmax(signed_axes(rotate(x, t)), axis=1))
                    yield pa.RecordBatch.from_arrays([pa.array(key), *(b.column(i).take(take) for i in range(3))], ["key", "node", "low", "vec"])

    schema = "key long, node long, low long, vec binary"
    index = _blocked(nodes.select("node", "low", "vec").mapInArrow(hashed, schema), BLOCK)
    index = materialize(index.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(64)).cast("int")), "ann-index")
    # The sizes of the buckets: at most tables x signed axes numbers for a band.
    counts = index.groupBy("key").agg(F.sum(F.size("nodes")).alias("n")).orderBy("key").toPandas()
    sent = spark.sparkContext.broadcast((counts["key"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)))

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes = sent.value
        for b in batches:
            for length, own, x in by_length(_vectors(b.column(2))):
                x = padded(x, np.array([length_of(v) for v in x]), True)
                buckets = [np.zeros(2 * x.shape[1], np.int64) for _ in longest]
                total = 0
                for t in range(tables):
                    axes = signed_axes(rotate(x, t))
                    near = np.argsort(-axes, axis=1, kind="stable")
                    for of, band in zip(buckets, longest):
                        lo, hi = np.searchsorted(keys, [bucket_key(length, band, t, 0), bucket_key(length, band, t + 1, 0)])
                        of[:] = 0
                        of[keys[lo:hi] & ((1 << 22) - 1)] = sizes[lo:hi]
                    if t == 0:
                        inside = [int(of.sum()) for of in buckets]
                        total = sum(inside)
                    for of, band, held in zip(buckets, longest, inside):
                        share = max(keep, math.ceil(min_candidates * held / max(1, total) / tables))
                        if not held or t and share >= held:  # probed whole in the first table
                            continue
                        n = of[near]
                        full = n > 0
                        before = np.cumsum(n, axis=1) - n
                        go = full & ((np.cumsum(full, axis=1) <= probes) | (before < share))
                        at, place = np.nonzero(go)
                        take = pa.array(own[at])
                        yield pa.RecordBatch.from_arrays([pa.array(bucket_key(length, band, t, near[at, place])), *(b.column(i).take(take) for i in range(3))],
                                                         ["key", "node", "low", "vec"])

    queries = _blocked(nodes.where("asked").select("node", "low", "vec").mapInArrow(probed, schema), QUERY_BLOCK)
    queries = materialize(queries.select("key", F.col("nodes").alias("qnodes"), F.col("vecs").alias("qvecs")), "ann-queries")
    found = (queries.join(index, "key").select("qnodes", "qvecs", "nodes", "lows", "vecs", "salt")
             .mapInArrow(_best(keep), "q long, node long, low long, score double, salt int"))
    # First within the blocks of a salt, then per query, so that a bucket of many blocks never meets in one group.
    best = (found.groupBy("q", "salt").agg(_top(keep).alias("top")).select("q", F.explode("top").alias("t"))
            .select("q", "t.node", "t.low", (-F.col("t.far")).alias("score")))
    best = best.groupBy("q").agg(_top(keep).alias("top")).select("q", F.explode("top").alias("t"))
    ids = nodes.select(F.col("node").alias("n"), "ids")
    listed = (best.select("q", F.col("t.node").alias("n"), F.col("t.far").alias("far")).join(ids, "n")
              .select("q", "far", F.explode("ids").alias("id"))
              .groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("far", "id"))), 1, keep).alias("list")))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(i, (np.array(v, np.float64) + 0.0).tobytes()) for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if v and None not in v]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["query_id", "vec"])

    who = given.where("asked").select("id", "v").distinct().mapInArrow(keyed, "query_id long, vec binary")
    who = who.join(nodes.where("asked").select("vec", F.col("node").alias("q")), "vec").select("query_id", "q")
    mine = who.join(listed, "q").select("query_id", F.slice(F.filter("list", lambda x: x["id"] != F.col("query_id")), 1, k).alias("list"))
    return (mine.select("query_id", F.posexplode("list").alias("at", "x"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.far")).alias("score")))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {"op4_ann": op4_ann}
ORACLES: dict[str, str] = {}
