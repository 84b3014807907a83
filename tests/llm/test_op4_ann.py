import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import op4_ann as op


def brute(rows, asked, k=20):
    out = []
    usable = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)})
    for i, v in usable:
        if asked(i):
            s = sorted((-(np.array(v) * np.array(w)).sum(), j) for j, w in usable if j != i and len(w) == len(v))[:k]
            out += [(i, n + 1, j, -x) for n, (x, j) in enumerate(s)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_recall_with_few_probes(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute([(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows], lambda i: i % 50 == 0)
    found = {(q, v) for q, _, v, _ in got(op.nearest(df, F.col("vec_id") % 50 == 0, min_candidates=1))}
    assert len({(q, v) for q, _, v, _ in want} & found) >= 0.9 * len(want)


def test_recall_with_mixed_norms_and_an_outlier(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(60, 32))
    x = centers[rng.integers(0, 60, 6000)] + 0.7 * rng.normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mixed = x * np.exp(0.5 * rng.normal(size=(6000, 1)))
    outlier = np.vstack([x, 20 * x[:1] + 0.1])
    for vectors in (mixed, outlier):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        found = {(q, v) for q, _, v, _ in got(op.nearest(df, F.col("vec_id") % 100 == 0, min_candidates=1))}
        want = set()
        for q in range(0, len(vectors), 100):
            score = vectors @ vectors[q]
            score[q] = -np.inf
            want |= {(q, int(v)) for v in np.argsort(-score)[:20]}
        assert len(found) == len(want) and len(want & found) >= 0.9 * len(want)


def test_small_tables_are_exact(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(120)]
    rows += [(200 + i, [1.0, 0.0, 2.0, 0.0, 0.0, 0.0]) for i in range(100)]  # one common vector
    rows += [(400, None), (401, []), (402, [0.0] * 6), (403, [nan] * 6), (404, [inf] * 6), (405, [None, 1.0]), (None, [1.0] * 6), (20, None),
             (500, [1.0, 2.0]), (520, [3.0, -1.0]), (60, rows[60][1]), (540, [-0.0, 0.0, 1e3, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).withColumn("node", F.lit(1))
    assert got(op.nearest(df, F.col("vec_id") % 20 == 0)) == brute(rows, lambda i: i % 20 == 0)
    assert op.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
