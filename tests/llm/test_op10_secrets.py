import pytest
from pyspark.sql import functions as F

from tidemark.llm import op10_secrets as op


@pytest.fixture(scope="module")
def learned(spark):
    from tests.conftest import SF01

    log, words = op.corpus_statistics(spark.read.parquet(f"{SF01}/documents.parquet").select("text"))
    return log, words, op.train(spark, op.labelled_findings(words=words), log, words)


def test_held_out_findings(spark, learned):
    from pyspark.ml.functions import array_to_vector

    log, words, model = learned
    found = op.labelled_findings(1500, seed=77, words=words)
    df = spark.createDataFrame([(op.features(*f[:4], log, words), float(f[4])) for f in found], "x array<double>, label double")
    got = model.transform(df.withColumn("features", array_to_vector("x"))).select("label", "prediction").collect()
    assert sum(r.label == r.prediction for r in got) >= 0.96 * len(got)


def test_statistics_cover_all_texts(spark):
    texts = ["abab token", "zzzz zzzz", None, "", "abab"]
    log, words = op.corpus_statistics(spark.createDataFrame([(t,) for t in texts], "text string"))
    import math

    assert words == {"abab", "token", "zzzz"}
    n = 1 + 4 + 0  # a -> b four times, plus one
    assert abs(log[0 * op.SYMBOLS + 1] - math.log(n / (op.SYMBOLS + 4 + 0))) < 1e-9


def test_corpus_tokens(spark):
    from tests.conftest import SF01

    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("text LIKE '%token = %'")
    got = op.scan_secrets(docs, F.col("source")).join(docs, "doc_id")
    planted = got.where("substring(text, place - 8, 9) = 'token = \"'")
    assert planted.count() > 0 and planted.where("NOT secret").count() == 0
    assert got.where("candidate RLIKE '^[0-9]{16}$' AND secret").count() == 0


def test_assigned_values_of_any_signs(spark, learned):
    from pyspark.ml.functions import array_to_vector

    secrets = ["Tr0ub4dor&3", "k!9x#Lq2vP", "QkzWvTnRbLxPmYhGfDsJ", "aB3$xZ9.q%", "p@5$w0rd.7xQ"]
    forms = ['password = "%s"\n', "DB_PASSWORD=%s\n", '{"client_secret": "%s"}', "api_key: '%s';", "$cfg['token'] => `%s`", "secret := %s;"]
    texts = [f % v for f in forms for v in secrets]
    assert all(v in [t[s:e] for s, e in op.places(t)] for t, v in zip(texts, secrets * len(forms)))
    assert [t[s:e] for t in ["key: a=b, password=x;y", 'key = ""', "token =", 'key = "open\n', "pwd='z"] for s, e in op.places(t)] == ["a=b", "x;y", "open", "z"]
    log, words, model = learned
    rows = [(op.features(v, f"some text {name} = \"", "\" more text here", "config/prod", log, words), 1) for v in secrets for name in ("password", "token")]
    rows += [(op.features(v, "the password: ", " and more text", "docs/guide", log, words), 0) for v in ("None", "changeme", "********", "${DB_PASSWORD}", "required")]
    df = spark.createDataFrame(rows, "x array<double>, label int").withColumn("features", array_to_vector("x"))
    got = model.transform(df).select("label", "prediction").collect()
    assert sum(r.label == r.prediction for r in got) >= 13


def _found(text):
    return [text[s:e] for s, e in op.places(text)]


def test_values_in_other_places():
    want = {"Authorization: Bearer QkzWvTnRbLx": "QkzWvTnRbLx", "curl -H \"Authorization: Basic dXNlcjpw\"": "dXNlcjpw", "see https://bob:hunter2x@host.example/a:b": "hunter2x",
            "<password>x9!y</password>": "x9!y", "run --password s3cr -v": "s3cr", "DB_PASS=Tr0ub4dor&3": "Tr0ub4dor&3", "a?token=v1&x=2": "v1"}
    assert {t: _found(t) for t in want} == {t: [v] for t, v in want.items()}
    assert _found("{key:v0a,token:'b c',secret:[d,e]}") == ["v0a", "b c", "[d"]
    assert _found("a.key=b1;c.token=d2;") == ["b1", "d2"]
    assert _found('key: "see password=abc and 0123456789abcdef01"') == ["see password=abc and 0123456789abcdef01", "abc", "0123456789abcdef01"]
    assert _found("https://a.example:8080/x@y and bearer of news, basic training") == []


def test_long_runs_without_white_space():
    import time

    n = 60_000
    for text, least in (("{" + ",".join(f"key:v{i}a" for i in range(n)) + "}", n), ("".join(f"key:v{i}a;" for i in range(n)), n), ("key:" * n, 1), ("key:\"" * n, 1),
                        ("key:\" token:' " * n, n), ("key=x&" * n, n), ("0123456789abcdef" * n, 1), ("://a:" * n, 0), ("--key " * n, 1), ("<key>" * n, 0), ("key:a;" + "b" * n * 10, 1)):
        start = time.time()
        got = op.places(text)
        assert len(got) >= least and sum(e - s for s, e in got) <= 4 * len(text) and time.time() - start < 10, text[:30]


def test_odd_rows(odd_docs, no_docs, spark):
    assert op.scan_secrets(odd_docs, F.col("source")).count() == 0
    assert op.scan_secrets(no_docs, F.col("source")).count() == 0
    key = "9f8d3b2a7c61e504f8a9b3c2d1e0f7a6"
    rows = [(None, f"secret = '{key}'", None), (1, f"x\nsecret = '{key}'\nsecret = '{key}'", "a"), (1, f"x\nsecret = '{key}'\nsecret = '{key}'", "a")]
    got = op.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string"), F.col("source")).collect()
    assert len(got) == 5 and all(r.candidate == key for r in got)
