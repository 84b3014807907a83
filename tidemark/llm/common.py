"""Helpers shared by the training-data operators: scratch tables in the shared
folder, blocks of hot buckets, and distributed connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, utc

#: What separates words when an operator counts or splits on white space:
#: the space and the control characters tab, line feed, vertical tab, form feed, carriage return.
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read in full.  Arrow batches are kept short, as a row may be a very long text."""
    utc(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the local test folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (named or ensure_checkpoint_dir(spark)).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/tidemark-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: cuts
    lineage, survives lost executors, and fixes what a later stage reads."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the scratch files of a materialized frame that nothing reads any more."""
    spark = df.sparkSession
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        if path.getName().startswith("tidemark-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(docs: DataFrame, **named) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``) and the ``named`` expressions over them; ``row.*`` unpacks."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in named.items()])


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session, for explicit range partitioning."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def salted(n_salts: int, *cols: str):
    """A salt in [0, n_salts) that is the same on every run: from the row's own columns."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(n_salts)).cast("int")


# ---------------------------------------------------------------- bucket blocks

#: Largest bucket whose members' sketches are all compared with each other.
LAGS = 32


def bucket_blocks(rows: DataFrame, key: str, member: str, order: str, block: int) -> DataFrame:
    """Cut the members of every bucket into blocks of at most ``block``.

    ``rows`` has a long ``key``, a long ``member`` and a long ``order``.  The
    rows are range-partitioned by (key, order, member), so a bucket that holds
    a third of all rows spreads over many tasks.  Returns (k, block_id,
    members array<long>, orders array<long>).  Block ids are unique.  Buckets of one member
    are left out, but for those at a partition's border, which may go on in the next."""
    n = partitions(rows)
    parts = (rows.select(F.col(key).alias("k"), F.col(order).alias("o"), F.col(member).alias("m"))
             .repartitionByRange(n, "k", "o", "m").sortWithinPartitions("k", "o", "m"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_m, held_o = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        first = open_key = None  # the partition's first key; the key of which a block has gone out already

        def emit(k: np.ndarray, m: np.ndarray, o: np.ndarray, last: bool):
            """The complete blocks and what is carried on.  A bucket of one member goes out only at
            the partition's borders, where its neighbour may hold more of it."""
            nonlocal open_key
            if not len(k):
                return None, k, m, o
            start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            size = np.diff(np.r_[start, len(k)])
            place = np.arange(len(k)) - np.repeat(start, size)
            cuts = np.flatnonzero(place % block == 0)
            keep = len(k) if last else cuts[-1]
            cuts = cuts[cuts < keep]
            if not len(cuts):
                return None, k, m, o
            rest = k[keep:], m[keep:], o[keep:]
            own, size = np.repeat(np.arange(len(size)), size)[:keep], np.repeat(size, size)[:keep]
            k, m, o = k[:keep], m[:keep], o[:keep]
            border = (k == first) | (k == open_key) | (last & (k == k[-1]))
            open_key = k[-1]
            stays = border | (size > 1)
            k, m, o, own = k[stays], m[stays], o[stays], own[stays]
            if not len(k):
                return None, *rest
            start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            place = np.arange(len(k)) - np.repeat(start, np.diff(np.r_[start, len(k)]))
            cuts = np.flatnonzero(place % block == 0)
            ends = pa.array(np.r_[cuts, len(k)].astype(np.int32), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in (m, o)]
            return pa.RecordBatch.from_arrays([pa.array(k[cuts], pa.int64()), *lists], ["k", "members", "orders"]), *rest

        more: list[tuple[np.ndarray, ...]] = []
        n = 0
        for b in batches:
            if first is None and b.num_rows:
                first = b.column(0)[0].as_py()
            more.append(tuple(b.column(i).to_numpy() for i in (0, 2, 1)))
            n += b.num_rows
            if n < 200_000:
                continue
            held_k, held_m, held_o = (np.concatenate([h, *x]) for h, x in zip((held_k, held_m, held_o), zip(*more)))
            more, n = [], 0
            out, held_k, held_m, held_o = emit(held_k, held_m, held_o, False)
            if out is not None:
                yield out
        if more:
            held_k, held_m, held_o = (np.concatenate([h, *x]) for h, x in zip((held_k, held_m, held_o), zip(*more)))
        out, _, _, _ = emit(held_k, held_m, held_o, True)
        if out is not None:
            yield out

    return (parts.mapInArrow(cut, "k long, members array<long>, orders array<long>")
            .withColumn("block_id", F.monotonically_increasing_id()))


def _partnered(k: np.ndarray, o: np.ndarray, size: np.ndarray, differing: int) -> np.ndarray:
    """Members of sorted buckets that have a near sketch in their bucket, or whose bucket is too large to say."""
    near = size > LAGS
    for lag in range(1, min(LAGS, len(k))):
        same = np.flatnonzero(k[lag:] == k[:-lag])
        if not len(same):
            break
        hit = same[np.bitwise_count((o[same] ^ o[same + lag]).view(np.uint64)) <= differing]
        near[hit] = near[hit + lag] = True
    return near


def band_blocks(rows: DataFrame, bands: int, parts: int, block: int, differing: int, run_keys: int = 1 << 20) -> DataFrame:
    """(k, block_id, members array<long>, orders array<long>, several boolean: whether the bucket may have more blocks), blocks as those of ``bucket_blocks``, for rows (id long from 0 on,
    keys binary: ``bands`` band keys and a sketch, 64 bits each).  A member of a bucket of up to ``LAGS`` whose sketch differs from all
    others in more than ``differing`` bits is left out, as is a bucket of one member.

    Band keys are evenly spread hashes: ``parts`` equal ranges of them are the groups in which members meet.  The keys travel packed,
    a run of rows and a part at a time.  A bucket with more than a block of members in one run sends its full blocks straight on, each
    to a task of its own choice, and only the rest and a mark to its part: a hot bucket spreads over all tasks, and
    its part gets at most a block of it per run."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                keys = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64).reshape(-1, bands + 1)
                held.append((b.column(0).to_numpy(), keys))
                n += keys.size
            if n >= run_keys:
                yield tuple(map(np.concatenate, zip(*held)))
                held, n = [], 0
        if held:
            yield tuple(map(np.concatenate, zip(*held)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys in runs(batches):
            k = keys[:, :bands].ravel().view(np.uint64)
            order = np.argsort(k)
            k, o, m = k[order], keys[order // bands, bands], ids[order // bands]
            start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            size = np.diff(np.r_[start, len(k)])
            full: list[tuple[int, bytes, bytes, bytes]] = []
            stays = np.ones(len(k), bool)
            marks = []
            for s, n in zip(start[size > block].tolist(), size[size > block].tolist()):
                own = s + np.lexsort((m[s:s + n], o[s:s + n]))
                for at in range(0, n - n % block, block):
                    x = own[at:at + block]
                    spread = parts + (int(m[x[0]]) * 0x9E3779B1 + int(k[s]) & 0xFFFFFFFF) % parts
                    full.append((spread, *(v[x].tobytes() for v in (k, o, m))))
                stays[own[:n - n % block]] = False
                marks.append(k[s])
            if marks:
                mark = np.array(marks, np.uint64)
                k, o, m = np.r_[k[stays], mark], np.r_[o[stays], np.zeros(len(mark), np.int64)], np.r_[m[stays], np.full(len(mark), -1)]
                order = np.argsort(k)
                k, o, m = k[order], o[order], m[order]
            p = ((k >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            ends = [*cuts[1:].tolist(), len(k)]
            some = [(int(p[a]), *(v[a:z].tobytes() for v in (k, o, m))) for a, z in zip(cuts.tolist(), ends)] + full
            for lo in range(0, len(some), 1000):
                part, *packs = zip(*some[lo:lo + 1000])
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), *(pa.array(x, pa.binary()) for x in packs)], ["p", "k", "o", "m"])

    def meet(group: pa.Table) -> pa.Table:
        k, o, m = (np.frombuffer(b"".join(group.column(c).to_pylist()), np.int64) for c in "kom")
        if group.column("p")[0].as_py() >= parts:  # full blocks
            several = np.ones(len(k), bool)
            cuts = np.arange(0, len(k), block)
        else:
            order = np.argsort(k)
            twice = k[order[1:]] == k[order[:-1]]
            order = order[np.r_[False, twice] | np.r_[twice, False]]
            k, o, m = k[order], o[order], m[order]
            marked = np.unique(k[m < 0])
            k, o, m = k[m >= 0], o[m >= 0], m[m >= 0]
            order = np.lexsort((m, o, k))
            k, o, m = k[order], o[order], m[order]

            def sizes():
                start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.empty(0, np.int64)
                size = np.diff(np.r_[start, len(k)])
                return np.arange(len(k)) - np.repeat(start, size), np.repeat(size, size)

            hot = np.isin(k, marked)
            stays = _partnered(k, o, sizes()[1], differing) | hot
            k, o, m, hot = k[stays], o[stays], m[stays], hot[stays]
            several = hot | (sizes()[1] > block)
            cuts = np.flatnonzero(sizes()[0] % block == 0)
        ends = pa.array(np.r_[cuts, len(k)].astype(np.int32), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in (m, o)]
        return pa.Table.from_arrays([pa.array(k[cuts], pa.int64()), *lists, pa.array(several[cuts])], ["k", "members", "orders", "several"])

    dealt = rows.select("id", "keys").mapInArrow(deal, "p long, k binary, o binary, m binary")
    return (dealt.groupBy("p").applyInArrow(meet, "k long, members array<long>, orders array<long>, several boolean")
            .withColumn("block_id", F.monotonically_increasing_id()))


def block_units(blocks: DataFrame) -> DataFrame:
    """Work units of a materialized block table: every block with itself if it has
    two members, and every two blocks of one bucket.  (a, a_orders, b, b_orders), members and orders;
    ``b`` is NULL for a block with itself.  Only buckets
    larger than one block (or cut by a partition border) reach the join."""
    none = F.lit(None).cast("array<long>")
    a = blocks.select("k", F.col("block_id").alias("ia"), F.col("members").alias("a"), F.col("orders").alias("a_orders"))
    solo = a.where(F.size("a") > 1).select("a", "a_orders", none.alias("b"), none.alias("b_orders"))
    if "several" in blocks.columns:
        several = blocks.where("several").select("k", F.col("block_id").alias("ia"), F.col("members").alias("a"), F.col("orders").alias("a_orders"))
    else:
        split = blocks.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k")
        several = a.join(split, "k", "left_semi")
    b = several.select("k", F.col("ia").alias("ib"), F.col("a").alias("b"), F.col("a_orders").alias("b_orders"))
    return solo.unionByName(several.join(b, "k").where("ia < ib").select("a", "a_orders", "b", "b_orders"))


def near_members(units: DataFrame, differing: int) -> DataFrame:
    """(unit, side, id, sketch): of work units (unit, a, a_orders, b, b_orders) whose orders are 64-bit sketches, the members that
    differ from some member they are to be compared with in at most ``differing`` bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # members of one small bucket have been compared already
            length = pc.list_value_length(batch.column(1)).to_numpy()
            plain = batch.column(3).is_null().to_numpy(zero_copy_only=False) & (length <= LAGS)
            whole = batch.filter(pa.array(plain))
            unit, side = [np.repeat(whole.column(0).to_numpy(), length[plain])], [np.zeros(length[plain].sum(), np.int32)]
            ids, sketches = ([whole.column(i).flatten().to_numpy()] for i in (1, 2))
            for r in range(batch.num_rows):
                if plain[r]:
                    continue
                no, a, oa, b, ob = (batch.column(i)[r] for i in range(5))
                a, oa = a.values.to_numpy(), oa.values.to_numpy().view(np.uint64)
                if b.is_valid:
                    b, ob = b.values.to_numpy(), ob.values.to_numpy().view(np.uint64)
                    near = np.bitwise_count(oa[:, None] ^ ob[None, :]) <= differing
                    parts = ((a, oa, near.any(axis=1)), (b, ob, near.any(axis=0)))
                else:
                    near = np.bitwise_count(oa[:, None] ^ oa[None, :]) <= differing
                    np.fill_diagonal(near, False)
                    parts = ((a, oa, near.any(axis=1)),)
                for s, (x, o, stays) in enumerate(parts):
                    unit.append(np.full(stays.sum(), no.as_py(), np.int64))
                    side.append(np.full(stays.sum(), s, np.int32))
                    ids.append(x[stays])
                    sketches.append(o[stays].view(np.int64))
            cat = lambda x, t: pa.array(np.concatenate(x) if x else np.empty(0, t))
            yield pa.RecordBatch.from_arrays([cat(unit, np.int64), cat(side, np.int32), cat(ids, np.int64), cat(sketches, np.int64)],
                                             ["unit", "side", "id", "sketch"])

    return units.select("unit", "a", "a_orders", "b", "b_orders").mapInArrow(run, "unit long, side int, id long, sketch long")


# ---------------------------------------------------------------- union-find

def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star forest (child, smallest member) with the same components as the edges."""
    nodes, inv = np.unique(np.r_[a, b], return_inverse=True)
    ia, ib = inv[:len(a)], inv[len(a):]
    root = np.arange(len(nodes))
    while True:
        lo = np.minimum(root[ia], root[ib])
        before = root.copy()
        np.minimum.at(root, root[ia], lo)
        np.minimum.at(root, root[ib], lo)
        while True:
            nxt = root[root]
            if (nxt == root).all():
                break
            root = nxt
        if (root == before).all():
            break
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


class UnionFind:
    """Path-halving union-find over 0..n-1, for the members of one work unit."""

    def __init__(self, n: int):
        self.p = list(range(n))

    def find(self, i: int) -> int:
        p = self.p
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def union(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.p[max(i, j)] = min(i, j)
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of each bounded run of a partition by their star forest."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def flush():
        child, root = local_forest(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
        return pa.RecordBatch.from_arrays([pa.array(child, pa.int64()), pa.array(root, pa.int64())], ["a", "b"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        n += batch.num_rows
        if n >= 500_000:
            yield flush()
            held, n = [], 0
    if n:
        yield flush()


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of (a long, b long) edges: (node, root), root being
    the smallest node; nodes without an edge are not returned.

    Distributed union-find: each round first contracts the edges of every
    partition to a star forest, then runs a large-star and a small-star step
    (joins on grouped minima, which combine before the shuffle).  The edge
    table is rewritten in the shared folder after every round, and the loop
    ends when a round no longer changes it: every edge then points at its root."""
    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = edges.select("a", "b").where("a <> b").mapInArrow(_contract, "a long, b long").distinct()
    e = materialize(e, f"{name}-0")
    seen, rounds = state(e), 0
    while True:
        rounds += 1
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a")
        nxt = (small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(low2.select("a", F.col("m").alias("b"))).distinct())
        nxt = materialize(nxt, f"{name}-{rounds}")
        now = state(nxt)
        drop_table(e)
        e = nxt
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
