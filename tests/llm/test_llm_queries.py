"""The package's queries run on the smallest data; those with SQL agree with DuckDB."""

from pathlib import Path

import duckdb
import pytest

from sparvane.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
QUERIES, SQL = queries.queries(), queries.oracle_sql()
COLUMNS = {
    "p1_found": ["field", "keep_id", "copy_id"], "p2_found": ["field", "id_a", "id_b"], "p3_found": ["type_a", "type_b"],
    "p5_found": ["file_id", "node_pos", "param"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_a", "doc_b"],
}


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark):
    frame = QUERIES[name](spark, DATA)
    rows = frame.collect()
    if name in COLUMNS:
        assert frame.columns == COLUMNS[name]
        assert len({str(r) for r in rows}) == len(rows)
    if name in SQL:
        con = duckdb.connect()
        for path in Path(DATA).glob("*.parquet"):
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        expected = con.sql(SQL[name])
        columns = list(expected.columns)
        assert sorted(columns) == sorted(frame.columns)
        assert sorted(tuple(r[c] for c in columns) for r in rows) == sorted(expected.fetchall())
