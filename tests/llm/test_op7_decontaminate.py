import random

import duckdb

from tests.llm.conftest import same_rows
from tidemark.llm import op7_decontaminate as op


def test_query_against_sql(spark):
    from tests.conftest import SF01

    assert same_rows(op.op7_decontaminate(spark, SF01), SF01, op.SQL)


def test_planted_passages(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(rng.choice([5, 6, 9, 14, 30, 70, 200])))) for i in range(60)]
    docs, want = [], set()
    for d in range(300):
        body = [word() for _ in range(rng.choice([3, 50, 400, 3000]))]
        i, text = items[rng.randrange(60)]
        words = text.split()
        if d % 3 == 0:  # whole, in other case and punctuation
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() + "," for w in words]
            want.add((d, i))
        elif d % 3 == 1:  # half of it is not enough
            body += words[:len(words) // 2]
        docs.append((d, " ".join(body)))
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in op.containment_pairs(df, it).collect()}
    assert got <= want | {(d, i) for d, i in got if len(items[i][1].split()) < 10}
    assert len(want & got) >= 0.99 * len(want)


def test_items_of_few_words(spark, tmp_path):
    rng = random.Random(9)
    items = [(1, "Alpha, beta"), (2, "gamma"), (3, "alpha beta gamma delta"), (4, "beta alpha beta"), (5, "gamma delta alpha beta alpha gamma"), (6, "?"), (7, "alpha beta")]
    docs = [(d, " ".join(rng.choice(["alpha", "beta", "GAMMA.", "delta"] + ["x", "y"] * (d % 9)) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 9, 40])))) for d in range(900)]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")

    def contained(item, doc, least=2):
        a, b = op.words(item), op.words(doc)
        k = min(5, len(a))
        if k < least and len(b) != k:
            return False
        want = {tuple(a[i:i + k]) for i in range(len(a) - k + 1)}
        return k > 0 and len(want & {tuple(b[i:i + k]) for i in range(len(b) - k + 1)}) >= 0.8 * len(want)

    for some in (items, items[:4]):
        got = [(r.doc_id, r.item_id) for r in op.containment_pairs(df, it.where(it.item_id <= some[-1][0])).collect()]
        assert len(got) > 50 and sorted(got) == sorted((d, i) for d, t in docs for i, a in some if contained(a, t))
    got = [(r.doc_id, r.item_id) for r in op.containment_pairs(df, it, min_words=1).collect()]
    assert sorted(got) == sorted((d, i) for d, t in docs for i, a in items if contained(a, t, 1))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    it.write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    cols = ["doc_id", "item_id", "shared", "item_shingles", "containment"]
    rows = con.execute(f"SELECT {', '.join(cols)} FROM ({op.SQL})").fetchall()
    assert rows and sorted(rows) == sorted(tuple(r[c] for c in cols) for r in op.op7_decontaminate(spark, str(tmp_path)).collect())


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "two three four five six", 1), (1, "two three four five six", 1), (None, "Three four FIVE six seven!", 1), (3, None, 1), (4, "", 1),
                                   (5, "x", 1)], "item_id long, text string, containment int")
    got = op.containment_pairs(odd_docs, items).collect()
    assert sorted(((r.doc_id, r.item_id, r.containment) for r in got), key=repr) == sorted([(d, i, 1.0) for d in (1, 2) for i in (1, None)], key=repr)
    kept = op.decontaminate(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert op.decontaminate(odd_docs, items.limit(0)).count() == odd_docs.count()
    assert op.containment_pairs(no_docs, items).count() == 0 and op.decontaminate(no_docs, items).count() == 0
