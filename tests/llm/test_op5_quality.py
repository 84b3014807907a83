from pyspark.sql import functions as F

from tidemark.llm import op5_quality as op


def test_held_out_accuracy(spark):
    from tests.conftest import SF01

    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    model = op.train(docs, labels.where("doc_id % 3 <> 0"))
    got = op.site_posteriors(op.score(docs, model, F.col("source"), F.col("lang"))).join(
        labels.where("doc_id % 3 = 0").select(F.col("doc_id"), "quality", F.col("toxic").alias("is_toxic")), "doc_id").collect()
    right = sum(r.accepted == (r.quality == 1 and r.is_toxic == 0) for r in got)
    clean = [r.accepted for r in got if r.quality == 1 and r.is_toxic == 0]
    assert len(got) > 100 and right >= 0.95 * len(got) and sum(clean) >= 0.98 * len(clean)


def test_sparse_sites_shrink(spark):
    rows = [(i, f"{i}", "good" if i % 2 else "bad", "p", 0.05 if i % 2 else 0.9, 0.1) for i in range(200)] + [(900, "900", "new", "p", 0.45, 0.1), (901, "901", "bad", "q", 0.45, 0.1)]
    df = spark.createDataFrame(rows, "doc_id long, row_key string, host string, path string, low double, toxic double")
    got = {r.doc_id: r for r in op.site_posteriors(df).collect()}
    assert got[0].path_low > 0.8 and got[1].path_low < 0.1
    assert 0.3 < got[900].path_low < 0.6  # a site without other rows has the global prior
    assert got[901].path_low > got[900].path_low  # a path without other rows has its host's


def test_odd_rows(spark, odd_docs, no_docs, labels):
    got = op.classify(odd_docs, labels, F.col("source"), F.col("lang"))
    assert got.count() == odd_docs.count() and got.where("accepted IS NULL").count() == 0
    kept = op.accepted(odd_docs, labels, F.col("source"), F.col("lang"))
    assert kept.columns == odd_docs.columns
    for l in (labels.limit(0), labels.where("doc_id = 1")):  # no labels, or one class: nothing is rejected
        assert op.accepted(odd_docs, l, F.col("source"), F.col("lang")).count() == odd_docs.count()
    assert op.accepted(no_docs, labels, F.col("source"), F.col("lang")).count() == 0
