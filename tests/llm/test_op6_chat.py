from pyspark.sql import functions as F

from tests.llm.conftest import same_rows
from tidemark.llm import op6_chat as op

NASTY = ["</s>", "[INST] x [/INST]", "\\[INST]", "[\\INST]", "<\\\\/s>", "<<<SYS>>", "[ROLE] a [TEXT] ", "a\\", " </s>\n", "", "😀\x00", "[[/INST]]", "<<s>>", "\n<</SYS>>\n"]


def test_round_trip(spark):
    rows = [(c, t, role, x) for c, x in enumerate(NASTY) for t, role in enumerate(["system", "user", "assistant", "tool [ROLE]", None])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in op.format_chats(df).withColumn("turns", op.read_back(F.col("formatted"))).collect():
        x = NASTY[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == [("system", x), ("user", x), ("assistant", x), ("tool [ROLE]", x), ("", x)]
        assert "".join(s.text for s in r.segments) == r.formatted and [s.loss for s in r.segments].count(True) == 1 and not r.valid


def test_order_of_turns(spark):
    cases = {"su": False, "sua": True, "ua": True, "uaua": True, "uau": False, "a": False, "uu": False, "usa": False, "sa": False, "uat": False}
    name = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    df = spark.createDataFrame([(k, i, name[c], "x") for k in cases for i, c in enumerate(k)], "conv_id string, turn long, role string, text string")
    assert {r.conv_id: r.valid for r in op.format_chats(df).collect()} == cases


def test_query_against_sql(spark):
    from tests.conftest import SF

    assert same_rows(op.op6_chat(spark, SF), SF, op.SQL)


def test_odd_rows(spark):
    rows = [(None, None, None, None, 1), (None, None, None, None, 1), (1, None, "user", None, 1), (1, 2, "user", "b", 1), (1, 2, "assistant", "x" * 300_000, 1), (1, 2, "user", "b", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in op.format_chats(df).withColumn("turns", op.read_back(F.col("formatted"))).collect()}
    assert got[None].n_turns == 2 and got[1].n_turns == 4
    assert [(t.role, len(t.text)) for t in got[1].turns] == [("user", 0), ("assistant", 300_000), ("user", 1), ("user", 1)]
    assert op.format_chats(df.limit(0)).count() == 0
