"""The text queries that have SQL, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from seqloom.llm import queries
from tests.test_oracles import rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ran = con.execute(queries.ORACLES[name])
    df = queries.QUERIES[name](spark, SF)
    names = [d[0] for d in ran.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, ran.fetchall())
