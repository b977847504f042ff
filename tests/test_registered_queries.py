"""Every registered query outside the text operators, beside its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import compare
from workload import lake_queries  # noqa: F401  (registers its queries)
from workload import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, name):
    mine = queries.QUERIES[name](spark, DATA).toArrow()
    con = duckdb.connect()
    for table in compare.TABLES:
        con.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    theirs = con.sql(queries.ORACLES[name]).to_arrow_table()
    assert compare.arrow_types(mine.schema) == compare.arrow_types(theirs.schema)
    assert compare.values(mine.to_pandas()) == compare.values(theirs.to_pandas())
