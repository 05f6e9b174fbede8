"""Operators that SQL can express: Spark's rows equal DuckDB's."""

import duckdb
import pytest

from conftest import SF_SMALL
from tessera.llm import oracle_sql, registry
from tools.check_oracle import rows_key


@pytest.mark.parametrize("name", sorted(oracle_sql.oracle_queries()))
def test_rows_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    found = registry.queries()[name](spark, SF_SMALL)
    wanted = con.execute(oracle_sql.oracle_queries()[name])
    cols = [d[0] for d in wanted.description]
    assert sorted(cols) == sorted(found.columns)
    rows = wanted.fetchall()
    assert rows and rows_key(cols, rows) == rows_key(found.columns, [tuple(r) for r in found.collect()])
