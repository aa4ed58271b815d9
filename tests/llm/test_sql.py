import re

import duckdb
import pytest

import __spark_entry__ as entry
import check
from clickloom.llm import queries
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for table in check.TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def test_registered():
    registered = entry.queries()
    assert [n for n in registered if re.match(r"op\d+_", n)] == [n for n in queries.QUERIES if n != "pipeline"]
    assert "pipeline" in registered


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sql, name):
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    want = sql.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.normal(got) == check.normal(want)
