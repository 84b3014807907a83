"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints: A-Z is lower-cased, words are runs of other than white space, shingles are
``shingle`` words joined by one space with repeats (a shorter text is one shingle; a text
without words has fingerprint zero), a shingle's hash is XXH64 (UTF-8, seed 42), and a
fingerprint bit is 1 if it is set in over half of the hashes.  Two texts link if their
fingerprints differ in at most ``max_distance`` bits; the result is the connected components.

Search: equal fingerprints are one node, so copies never meet in a task.  With m bit
blocks two fingerprints at distance d agree on m - d of them, so every distinct fingerprint goes
to one bucket per choice of m - d blocks (m grows with the number of fingerprints, which keeps buckets
small at any size).  A bucket is sorted by Gray rank and cut into blocks; in a block
the index factors the bits that eight neighbours share into an upper node, eight upper nodes into
the next, and so on.  A search walks pairs of nodes from the top and adds up the
differences in newly shared bits; a pair that passes the distance is dropped with all below it.
Only a spanning forest of the links leaves a task; the components are found by distributed union-find.

Nulls and ties: a null text is a text without words (fingerprint zero, linked like
any other); a row with a null doc_id takes part, and is labelled by the smallest doc_id of its
component (null if there is none); rows that repeat a doc_id each get a row; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import block_units, bucket_blocks, components, local_forest, materialize, packed, table

SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
BLOCK = 2048
FANOUT = 8
#: Pairs of nodes that a step of the search makes at most, codes that are indexed together (but for a longer bucket block), and
#: links that are held before they are contracted: they bound a task's memory whatever its batches hold.
FRONTIER = 400_000
INDEXED = 200_000
HELD_LINKS = 500_000
ROWS_PER_BUCKET = 256
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text as an unsigned integer."""
    words = (text or "").encode().translate(_LOWER).split()  # bytes.split() knows exactly the six ASCII white spaces
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    k = min(shingle, n)
    pieces = map(joined.__getitem__, map(slice, starts[:n - k + 1].tolist(), ends[k - 1:].tolist()))
    h = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, n - k + 1)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        counts += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_key, fp): the fingerprint as a signed long; the row key tells rows apart by id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fp, pa.int64())], ["doc_id", "row_key", "fp"])

    three = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        row_key(id_col, text_col).alias("row_key"))
    return three.mapInArrow(run, "doc_id long, row_key string, fp long")


def row_key(id_col: str, text_col: str) -> Column:
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("~")), F.hex(F.xxhash64(text_col)))


def gray_rank(fp: Column) -> Column:
    """Place of a code in Gray order: the exclusive-or of all its right shifts, in doubling steps."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def bucket_masks(n: int, distance: int = MAX_DISTANCE, rows_per_bucket: int = ROWS_PER_BUCKET) -> list[int]:
    """One bit mask per choice of the blocks on which a linked pair must agree."""
    blocks = distance + 1
    while blocks < 2 * distance and n > rows_per_bucket * 2 ** (64 * (blocks - distance) // blocks):
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    bits = [sum(1 << j for j in range(a, b)) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(bits, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


# ------------------------------------------------------------ the index in a task

def build_index(codes: np.ndarray, unit: np.ndarray, fanout: int = FANOUT) -> list[dict]:
    """Levels from the leaves up to one node per unit.  ``codes`` are in Gray order inside
    each unit (``unit`` is ascending).  A node has the bits its leaves share (mask, val) and its children's range."""
    ones = np.full(len(codes), np.uint64(0xFFFFFFFFFFFFFFFF))
    levels = [{"mask": ones, "val": codes, "unit": unit}]
    while True:
        at = levels[-1]
        first = np.flatnonzero(np.r_[True, at["unit"][1:] != at["unit"][:-1]])
        if len(first) == len(at["unit"]):
            return levels
        place = np.arange(len(at["unit"])) - np.repeat(first, np.diff(np.r_[first, len(at["unit"])]))
        lo = np.flatnonzero(place % fanout == 0)
        every = np.bitwise_and.reduceat(at["val"] | ~at["mask"], lo)  # ones wherever no leaf has a shared zero
        some = np.bitwise_or.reduceat(at["val"] & at["mask"], lo)
        mask = np.bitwise_and.reduceat(at["mask"], lo) & ~(every ^ some)
        levels.append({"mask": mask, "val": some & mask, "unit": at["unit"][lo], "lo": lo, "hi": np.r_[lo[1:], len(at["unit"])]})


def search_index(levels_a: list[dict], levels_b: list[dict] | None, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs (i, j) within ``distance``, in runs; ``levels_b`` None: pairs i < j inside each unit."""
    same = levels_b is None
    levels_b = levels_a if same else levels_b
    while len(levels_a) < len(levels_b):
        levels_a = levels_a + [levels_a[-1] | {"lo": np.arange(len(levels_a[-1]["val"])), "hi": np.arange(len(levels_a[-1]["val"])) + 1}]
    while len(levels_b) < len(levels_a):
        levels_b = levels_b + [levels_b[-1] | {"lo": np.arange(len(levels_b[-1]["val"])), "hi": np.arange(len(levels_b[-1]["val"])) + 1}]
    top = len(levels_a) - 1
    A, B = levels_a[top], levels_b[top]
    i = np.arange(len(A["val"]))
    if same:
        j = i
    else:  # two blocks: one root each
        j = np.zeros(len(i), np.int64)
    shared = A["mask"][i] & B["mask"][j]
    acc = np.bitwise_count((A["val"][i] ^ B["val"][j]) & shared).astype(np.int64)
    near = acc <= distance
    stack = [(top, i[near], j[near], shared[near], acc[near])]
    while stack:
        level, i, j, shared, acc = stack.pop()
        if level == 0:
            if same:
                i, j = i[i != j], j[i != j]
            if len(i):
                yield i, j
            continue
        A, B = levels_a[level], levels_b[level]
        na, nb = A["hi"][i] - A["lo"][i], B["hi"][j] - B["lo"][j]
        n = na * nb
        if len(i) > 1 and n.sum() > FRONTIER:
            half = len(i) // 2
            for e in (slice(half, None), slice(half)):
                stack.append((level, i[e], j[e], shared[e], acc[e]))
            continue
        pair = np.repeat(np.arange(len(i)), n)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        ci, cj = A["lo"][i][pair] + k // nb[pair], B["lo"][j][pair] + k % nb[pair]
        if same:  # a node with itself: each pair of children once
            keep = (i[pair] != j[pair]) | (ci <= cj)
            pair, ci, cj = pair[keep], ci[keep], cj[keep]
        below_a, below_b = levels_a[level - 1], levels_b[level - 1]
        both = below_a["mask"][ci] & below_b["mask"][cj]
        d = acc[pair] + np.bitwise_count((below_a["val"][ci] ^ below_b["val"][cj]) & both & ~shared[pair])
        ok = d <= distance
        stack.append((level - 1, ci[ok], cj[ok], both[ok], d[ok]))


def _search(distance: int):
    def found(a: pa.ListArray, b: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        solo = a.filter(b.is_null())
        size = pa.compute.list_value_length(solo).to_numpy()
        ends = np.cumsum(size)
        lo = 0
        while lo < len(solo):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + INDEXED, side="right")))
            codes = solo[lo:hi].flatten().to_numpy().view(np.uint64)
            for i, j in search_index(build_index(codes, np.repeat(np.arange(hi - lo), size[lo:hi])), None, distance):
                yield codes[i].view(np.int64), codes[j].view(np.int64)
            lo = hi
        for x, y in zip(a.filter(b.is_valid()), b.filter(b.is_valid())):
            ca, cb = x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64)
            for i, j in search_index(build_index(ca, np.zeros(len(ca), np.int64)), build_index(cb, np.zeros(len(cb), np.int64)), distance):
                yield ca[i].view(np.int64), cb[j].view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: list[tuple[np.ndarray, np.ndarray]] = []
            held = 0

            def forest():
                links[:] = [local_forest(*(np.concatenate(x) for x in zip(*links)))]
                return len(links[0][0])

            def out():
                return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in links.pop()], ["a", "b"])

            for pair in found(batch.column(0), batch.column(1)):
                links.append(pair)
                held += len(pair[0])
                if held > HELD_LINKS:
                    held = forest()
                    if 2 * held > HELD_LINKS:  # a forest of as many codes goes out
                        yield out()
                        held = 0
            if links:
                forest()
                yield out()
    return run


def hamming_links(codes: DataFrame, distance: int = MAX_DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct codes (column fp, long) whose components are those of all pairs within ``distance``."""
    masks = bucket_masks(codes.count(), distance)
    keyed = codes.select("fp", gray_rank(F.col("fp")).alias("gray"), F.explode(F.array(
        *[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)])).alias("key"))
    blocks = materialize(bucket_blocks(keyed, "key", "fp", "gray", block), "simhash-blocks")
    return block_units(blocks).select("a", "b").mapInArrow(_search(distance), "a long, b long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, row_key, fp, root_fp, component_id) per row of ``docs``; ``root_fp`` names the component by one of its fingerprints."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    codes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-codes")
    cc = components(hamming_links(codes.select("fp"), max_distance), "simhash-cc")
    named = codes.join(cc, codes.fp == cc.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root_fp"))
    ids = named.groupBy("root_fp").agg(F.min("low").alias("component_id"))
    return fps.join(named.join(ids, "root_fp").select("fp", "root_fp", "component_id"), "fp")


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with one row of every component: that with the smallest doc_id (null last),
    among rows of one id that with the smallest row key, among identical rows any."""
    marked = simhash_components(docs.select("doc_id", "text"), **params)
    first = marked.groupBy("root_fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("m"))
    keep = first.select(F.col("m.row_key").alias("key")).distinct()
    kept = packed(docs, key=row_key("doc_id", "text")).join(keep, "key", "left_semi")
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
    return kept.withColumn("nth", nth).where("nth = 1").select("row.*")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    got = simhash_components(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash": op2_simhash}
ORACLES: dict[str, str] = {}
