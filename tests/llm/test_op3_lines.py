import random
from collections import defaultdict

from tidemark.llm import common
from tidemark.llm import op3_lines as op
from tidemark.llm.common import UnionFind


def brute(rows):
    """{(doc_id, text): removed line numbers} by comparing all lines."""
    place = defaultdict(list)
    for d, t in set(rows):
        for p, x in enumerate((t or "").split("\n")):
            if op.normal(x):
                place[op.normal(x)].append((d is None, d or 0, t, p))
    lines = list(place)
    sets, uf = [op.shingles(x) for x in lines], UnionFind(len(lines))
    for i in range(len(lines)):
        for j in range(i):
            if op.similar(sets[i], sets[j]):
                uf.union(i, j)
    group = defaultdict(list)
    for i, x in enumerate(lines):
        group[uf.find(i)] += place[x]
    return group


def test_against_brute_force(spark):
    from tests.conftest import SF

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(80).collect()]
    rng = random.Random(2)
    base = "this very line is copied around with a word or two changed here and there in many of the documents"
    for k in range(60):
        words = base.split()
        words[rng.randrange(len(words))] = f"w{k}"
        rows.append((1000 + k, "some own line %d\n%s\n\nshared tail" % (k * 7919, " ".join(words))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, p) for r in op.removed_lines(df).collect() for p in r.removed}
    want = set()
    for members in brute(rows).values():
        first = min((m[0], m[1]) for m in members), min(m[3] for m in members if m[1] == min(x[1] for x in members))
        want |= {(m[1], m[3]) for m in members} - {(first[0][1], first[1])}
    assert got == want


def test_recall_of_the_bands():
    rng, found, near = random.Random(4), 0, 0
    bands, rows = op.banding(10**6)
    for k in range(400):
        line = [rng.choice("abcdefghij ") for _ in range(rng.randint(60, 300))]
        other = list(line)
        while op.similar(op.shingles("".join(line)), op.shingles("".join(other)), 0.8):
            last, other = list(other), list(other)
            other[rng.randrange(len(other))] = rng.choice("klmnop")
        a, b = op.band_keys([op.normal("".join(line)), op.normal("".join(last))], bands, rows).tolist()
        found += bool(set(a[:-1]) & set(b[:-1]))
        near += ((a[-1] ^ b[-1]) & (2**64 - 1)).bit_count() <= op.DIFFERING
    assert found >= 0.98 * 400 and near == 400


def test_recall_on_short_lines():
    rng = random.Random(8)
    for lines in (10**6, 5 * 10**7):
        bands, rows = op.banding(lines)
        found = near = 0
        for _ in range(1500):
            n = rng.randint(8, 60) // 5 * 5 + 3  # the union of the shingles is a multiple of five, four fifths of it are shared
            own = (n - 3) // 5
            text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n + 1))
            line, other = text[:len(text) - own // 2], text[own - own // 2:]
            assert len(op._as_set(op.shingles(line)) & op._as_set(op.shingles(other))) >= 0.8 * (n - 3)
            a, b = op.band_keys([line, other], bands, rows).tolist()
            found += bool(set(a[:-1]) & set(b[:-1]))
            near += ((a[-1] ^ b[-1]) & (2**64 - 1)).bit_count() <= op.DIFFERING
        assert found >= 0.99 * 1500 and near >= 1498


def test_sketch_of_a_line_is_that_of_its_set():
    rng = random.Random(9)
    lines = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 30))) * rng.choice([1, 1, 40]) for _ in range(300)] + ["a" * 50_000, "a"]
    for bands, rows in (op.banding(1), op.banding(10**9)):
        together = op.band_keys(lines, bands, rows)
        assert all((op.band_keys([x], bands, rows)[0] == y).all() for x, y in zip(lines, together))
    assert (op.band_keys(["a" * 9, "a" * 5000], 11, 4)[0] == op.band_keys(["a" * 9, "a" * 5000], 11, 4)[1]).all()


def test_similarity_is_exact():
    rng = random.Random(6)
    plain = lambda x: {x[i:i + 5] for i in range(max(1, len(x) - 4))} if len(x) >= 5 else {x.ljust(5, "\0")}
    for _ in range(400):
        a = "".join(rng.choice("abcé漢😀 ") if rng.random() < 0.1 else rng.choice("abc") for _ in range(rng.randint(1, 40)))
        b = a[:rng.randint(0, len(a))] + "".join(rng.choice("abc漢") for _ in range(rng.randint(1, 6)))
        x, y = plain(a), plain(b)
        assert op.similar(op.shingles(a), op.shingles(b)) == (len(x & y) >= 0.8 * len(x | y))


def test_bands_grow_with_the_lines():
    for lines in (1, 10**6, 10**9, 10**12):
        bands, rows = op.banding(lines)
        assert 1 - (1 - 0.8 ** rows) ** bands >= 0.996 and lines * 0.2 ** (rows - 3) < 5e6


def test_odd_rows(odd_docs, no_docs):
    out = op.dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns and out.schema == odd_docs.schema
    got = sorted(((r.doc_id or 0, r.text, r.n_chars) for r in out.collect()), key=repr)
    assert len(got) == odd_docs.count()
    assert sum(g[1] == "one two three four five six seven" for g in got) == 2  # repeated rows agree
    assert (2, "", 0) in got and (8, "idiot\nx\n", 8) in got and (0, None, None) in got and (6, " \n\t ", 4) in got
    assert op.dedup_lines(no_docs).count() == 0


def test_bands_meet_in_blocks_wherever_their_rows_are(spark):
    rng, bands, block = random.Random(5), 3, 4
    rows, bucket = [], defaultdict(set)
    for i in range(400):
        keys = [7 if b == 0 and i % 2 else rng.randrange(150) * 2**56 + b for b in range(bands)]  # key 7: a hot bucket
        sketch = 2**40 - 1 if i % 50 == 3 and keys[0] != 7 else rng.randrange(4)
        rows.append((i, b"".join((x & 2**64 - 1).to_bytes(8, "little") for x in [*keys, sketch])))
        for x in keys:
            bucket[x - 2**64 if x >= 2**63 else x].add((i, sketch))
    want = {frozenset((a, b)) for m in bucket.values() for a, s in m for b, t in m if a < b and (s ^ t).bit_count() <= 18}
    for parts in (1, 13):
        df = spark.createDataFrame(rows, "id long, keys binary").repartition(5)
        blocks = common.materialize(common.band_blocks(df, bands, parts, block, 18, run_keys=64), "test-blocks")
        assert all(len(r.members) <= block and r.members and len(r.members) == len(r.orders) for r in blocks.collect())
        met = {frozenset((a, b)) for u in common.block_units(blocks).collect() for a in u.a for b in (u.b or u.a) if a != b}
        assert want <= met


def test_bins_bound_what_two_sets_share():
    rng = random.Random(12)
    lines = ["".join(rng.choice("abcé漢😀 ") if rng.random() < 0.05 else rng.choice("abcd") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    sets, size, counts = op._sets(lines)
    for x, s, n in zip(lines, sets, size):
        assert op._as_set(s) == op._as_set(op.shingles(x)) and len(s) == n
    for _ in range(2000):
        i, j = rng.randrange(200), rng.randrange(200)
        assert len(op._as_set(sets[i]) & op._as_set(sets[j])) <= min(counts[i].sum(), counts[j].sum(), sum(map(min, counts[i].tolist(), counts[j].tolist())))


def test_lines_of_a_text_in_normal_form():
    for t in ["a b\nC d", " a\nb", "a \nb", "a\n b", "a  b\n\nc", "a\tb\r\nc", "x y\nz", "ΑΣ\nΣ", "a\x1cb", "é\n", "\n", "a\x85b\x0bc "]:
        assert op.normal_lines(t) == [op.normal(x) for x in t.split("\n")]


def test_equal_lines_of_a_run_are_one_row_with_their_first_place():
    import pyarrow as pa

    texts = ["Same line here\nown line", "own line too\n\nsame  line HERE\nsame line here", None, "same line here", "same line here"]
    ids = [7, 3, 1, None, 3]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([5, 6, 0, -9, 2], pa.int64()), pa.array(texts)], ["doc_id", "text_hash", "text"])
    got = pa.Table.from_batches(list(op._lines(11, 4)(iter([batch])))).to_pylist()
    assert [(r["doc_id"], r["pos"]) for r in got] == [(7, 0), (7, 1), (3, 0), (3, 2), (3, 3), (None, 0), (3, 0)]
    assert len({r["line"] for r in got}) == 3
    carried = [(r["doc_id"], r["text_hash"], r["pos"], r["n"]) for r in got if r["n"]]
    assert sorted(carried, key=repr) == sorted([(3, 2, 0, 5), (7, 5, 1, 1), (3, 6, 0, 1)], key=repr)
    assert all((r["n"] > 0) == (r["keys"] is not None) for r in got)
    keys = {r["line"]: r["keys"] for r in got if r["n"]}
    assert keys[got[0]["line"]] == op.band_keys(["same line here"], 11, 4).tobytes()


def test_line_count(spark, odd_docs, no_docs):
    want = sum(r.text.count("\n") + 1 for r in odd_docs.collect() if r.text is not None)
    assert op.line_count(odd_docs) == want and op.line_count(no_docs) == 0
