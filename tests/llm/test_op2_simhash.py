import random

import numpy as np

from tidemark.llm import op2_simhash as op
from tidemark.llm.common import UnionFind


def brute(rows):
    fps = [op.fingerprint(t) for _, t in rows]
    uf = UnionFind(len(rows))
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 4:
                uf.union(i, j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[uf.find(i)] = min(low.get(uf.find(i), d), d)
    return sorted(((d, f"{f:016x}", low.get(uf.find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps))), key=repr)


def result(df):
    return sorted(((r.doc_id, f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in df.collect()), key=repr)


def test_fingerprint_by_definition():
    import xxhash

    for text in ("", "One two", "a B\tc\x0bd\x1fe  F g", "ÄB c d e f"):
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
        shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        assert op.fingerprint(text) == sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def test_against_brute_force(spark):
    from tests.conftest import SF

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rng = random.Random(1)
    for k in range(150):  # near copies of one long text, and copies
        words = rows[3][1].split() * 6
        words[rng.randrange(len(words))] = f"new{k}"
        rows.append((10_000 + k, " ".join(words)))
    rows += [(20_000, rows[0][1]), (20_000, rows[0][1]), (None, rows[0][1]), (30_000, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(op.simhash_components(df)) == brute(rows)


def test_index_finds_every_pair():
    rng = np.random.default_rng(5)
    for distance in (4, 6):
        base = rng.integers(0, 2**63, 5, dtype=np.uint64)
        codes = base[rng.integers(0, 5, 700)]
        for _ in range(5):
            codes ^= np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64)
        codes = np.unique(codes)
        index = op.build_index(codes, np.zeros(len(codes), np.int64))
        got = {(min(i, j), max(i, j)) for a, b in op.search_index(index, None, distance) for i, j in zip(a.tolist(), b.tolist())}
        want = {(i, j) for j in range(len(codes)) for i in np.flatnonzero(np.bitwise_count(codes[:j] ^ codes[j]) <= distance).tolist()}
        assert got == want
        other = codes[:5] ^ np.uint64(7)
        cross = {(i, j) for a, b in op.search_index(index, op.build_index(other, np.zeros(5, np.int64)), distance) for i, j in zip(a.tolist(), b.tolist())}
        assert cross == {(i, j) for j in range(5) for i in np.flatnonzero(np.bitwise_count(codes ^ other[j]) <= distance).tolist()}


def test_small_blocks_lose_no_link(spark):
    rng = np.random.default_rng(9)
    codes = np.unique(np.uint64(0x123456789ABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)))
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    links = op.hamming_links(df, block=16).collect()
    uf, at = UnionFind(len(codes)), {int(c): i for i, c in enumerate(codes.view(np.int64))}
    for r in links:
        uf.union(at[r.a], at[r.b])
    assert len({uf.find(i) for i in range(len(codes))}) == 1


def test_bucket_masks_cover_every_pair():
    for n in (10, 10**7, 10**10, 10**13):
        masks, rng = op.bucket_masks(n), random.Random(n)
        for _ in range(300):
            flips = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not flips & m for m in masks)


def test_odd_rows(spark, odd_docs, no_docs):
    got = op.simhash_components(odd_docs)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert result(got) == brute(rows)
    kept = op.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len({(x[1] if x[2] is None else x[2]) for x in brute(rows)})
    assert op.simhash_components(no_docs).count() == 0 and op.keep_one(no_docs).count() == 0


def test_search_is_bounded_in_memory():
    import tracemalloc

    rng = np.random.default_rng(3)
    flips = np.uint64(1) << rng.integers(0, 64, (2, 2000)).astype(np.uint64)
    codes = np.unique(np.uint64(0x123456789ABCDEF) ^ flips[0] ^ flips[1])  # any two differ in at most four bits
    gray = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        gray ^= gray >> np.uint64(shift)
    codes = codes[np.argsort(gray)]
    units = 25
    index = op.build_index(np.tile(codes, units), np.repeat(np.arange(units), len(codes)))
    tracemalloc.start()
    pairs = sum(len(i) for i, _ in op.search_index(index, None, 4))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pairs == units * len(codes) * (len(codes) - 1) // 2
    assert peak < 150 << 20, f"{peak >> 20} MB"


def test_links_go_out_in_bounded_runs(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(4)
    monkeypatch.setattr(op, "HELD_LINKS", 100)
    monkeypatch.setattr(op, "INDEXED", 500)
    blocks = [np.unique(c ^ (np.uint64(1) << np.arange(30, dtype=np.uint64))) for c in rng.integers(0, 2**63, 60, dtype=np.uint64)]
    lists = pa.array([b.view(np.int64).tolist() for b in blocks] + [blocks[0][:15].view(np.int64).tolist()], pa.list_(pa.int64()))
    other = pa.array([None] * len(blocks) + [blocks[0][15:].view(np.int64).tolist()], pa.list_(pa.int64()))
    got = list(op._search(4)(iter([pa.RecordBatch.from_arrays([lists, other], ["a", "b"])])))
    a, b = (np.concatenate([x.column(i).to_numpy() for x in got]) for i in (0, 1))
    child, root = op.local_forest(a, b)
    assert len(got) > 1 and len(child) == 60 * 29 and len(np.unique(root)) == 60
