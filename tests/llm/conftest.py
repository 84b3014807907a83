"""Fixtures of the training-data tests: awkward rows every operator must take, and DuckDB over the same files."""

import duckdb
import pytest

TABLES = "documents embeddings pages benchmark labels conversations".split()
LONG = " ".join(f"word{i % 977}" for i in range(40_000))
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, fp string, key string, line string, low string, "
              "toxic string, _row string, _row_key string, _id string, size string, mix_epoch string")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing extra columns."""
    x = ("e",) * 10
    rows = [(1, "one two three four five six seven", "en", "a", 33) + x, (1, "one two three four five six seven", "en", "a", 33) + x,
            (2, "One two three four five six seven", None, "a", 33) + x, (None, None, None, None, None) + (None,) * 10,
            (None, "a line alone\nanother line", "en", "b", 25) + x, (None, "a line alone\nanother line", "en", "b", 25) + x,
            (5, "", "en", "b", 0) + x, (6, " \n\t ", "en", None, 4) + x, (7, LONG, "de", "c", len(LONG)) + x,
            (8, "idiot\nx\n\nx", "de", "c", 10) + x, (9, "ü😀 é\x00ö", "de", "c", 7) + x]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (8, 0, 1), (None, 0, 1), (5, None, None), (2, 1, 0)], "doc_id long, quality int, toxic int")


def sql_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    return [c[0] for c in cur.description], cur.fetchall()


def same_rows(df, sf_dir: str, sql: str) -> bool:
    cols, rows = sql_rows(sf_dir, sql)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert sorted(df.columns) == sorted(cols)
    return got == sorted((tuple(map(plain, r)) for r in rows), key=repr)
