"""Every registered query runs on the smallest data; those with SQL give the same rows as DuckDB."""

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from sparvane.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if value is None or isinstance(value, (bool, int, float)):
        return value
    return str(value)


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, duck):
    frame = QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    rows = Counter(repr([plain(r[c]) for c in columns]) for r in frame.collect())
    if name not in SQL:
        return
    expected = duck.sql(SQL[name])
    names = list(expected.columns)
    assert sorted(names) == columns
    want = Counter(repr([plain(r[names.index(c)]) for c in columns]) for r in expected.fetchall())
    assert rows == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["doc_id", "lang", "source", "n_chars"]
    assert set(SQL) <= set(QUERIES)
