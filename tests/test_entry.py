"""Driver contract."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 5


def test_oracle_keys_are_queries():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100


def test_no_current_timestamp_in_checked_sql():
    for sql in E.oracle_sql().values():
        assert "current_timestamp" not in sql.lower()


def test_bars_are_built_once(spark):
    from tests.conftest import SF
    from tidemark.catalog import common, q_outcomes

    for bars in (common.bars_all, q_outcomes.bars_plan):
        plan = bars(spark, SF)._jdf.queryExecution().toString()
        assert "Aggregate" not in plan and "FileScan" not in plan
