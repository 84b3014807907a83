from pyspark.sql import functions as F

from tests.llm.conftest import same_rows
from tidemark.llm import op8_mixing as op


def test_query_against_sql_and_again(spark):
    from tests.conftest import SF

    assert same_rows(op.op8_mixing(spark, SF), SF, op.SQL)
    assert sorted(map(tuple, op.op8_mixing(spark, SF).collect())) == sorted(map(tuple, op.op8_mixing(spark, SF).collect()))


def test_targets_by_resharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 300, "d": 5, None: 77}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in op.source_targets(df).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    want, left, open_ = {}, 1.5 * sum(sizes.values()), set(sizes)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            want[s] = 2 * sizes[s]
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    want |= share
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)


def test_taken_words_meet_the_targets(spark):
    from tests.conftest import SF

    plan = op.curriculum(spark.read.parquet(f"{SF}/documents.parquet"), rows_per_bucket=5)
    for r in plan.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) < 1
    assert plan.where("taken > 2 * size").count() == 0


def test_positions_invert_the_schedule():
    import numpy as np

    for knots in op.SCHEDULES:
        (ts, ws) = zip(*knots)
        grid = np.linspace(0, 1, 20_001)
        level = np.interp(grid, ts, ws)
        total = np.concatenate([[0], np.cumsum((level[1:] + level[:-1]) / 2)])
        total /= total[-1]
        pieces = op._pieces(knots)
        for share in np.linspace(0, 1, 31):
            t0, t1, a, slope, before = [p for p in pieces if p[4] <= share + 1e-12][-1]
            need = share - before
            x = t0 + 2 * need / (a + (a * a + 2 * slope * need) ** 0.5)
            assert abs(np.interp(share, total, grid) - x) < 1e-3


def test_training_order(spark):
    from tests.conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = {r.doc_id: r.taken for r in op.curriculum(docs).collect()}
    rows = op.training_order(docs).collect()
    assert [r.mix_position for r in rows] == sorted(r.mix_position for r in rows) and all(0 <= r.mix_position <= 1 for r in rows)
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.mix_words
    assert got == {d: t for d, t in plan.items() if t}


def test_odd_rows(odd_docs, no_docs):
    plan = op.curriculum(odd_docs).collect()
    assert len(plan) == odd_docs.count() and sum(r.size == 0 and r.taken == 0 for r in plan) == 3
    out = op.training_order(odd_docs)
    assert out.columns == [c for c in odd_docs.columns if c != "mix_epoch"] + ["mix_epoch", "mix_words", "mix_position"] and out.count() > 0
    assert op.curriculum(no_docs).count() == 0 and op.training_order(no_docs).count() == 0


def test_query_gives_the_times_of_the_schedules(spark):
    from tests.conftest import SF

    got = op.op8_mixing(spark, SF).collect()
    assert all((r.first_position is None) == (r.taken == 0) == (r.last_position is None) for r in got)
    assert all(0 <= r.first_position <= r.last_position <= 1 for r in got if r.taken)
    order = op.training_order(spark.read.parquet(f"{SF}/documents.parquet"))
    want = order.groupBy("doc_id").agg(F.round(F.min("mix_position"), 6).alias("a"), F.round(F.max("mix_position"), 6).alias("b"))
    assert {(r.doc_id, r.first_position, r.last_position) for r in got if r.taken} == {tuple(r) for r in want.collect()}
