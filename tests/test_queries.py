import duckdb
import pytest

import __spark_entry__ as entry
import check
from clickloom.check_sql import ORACLE_SQL
from tests.conftest import SMALL

NAMES = list(ORACLE_SQL)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for table in check.TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql())
    corpus = set(entry.corpus.QUERIES) if entry.corpus else set()
    assert set(entry.queries()) - corpus == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sql, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    want = sql.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.normal(got) == check.normal(want)


def test_counts(spark):
    counts = entry.entry(spark).groupBy("alert_type").count().collect()
    kinds = {r.alert_type: r["count"] for r in counts}
    assert kinds == {"INTENT_CAPTURED": 236, "CHECKOUT_FRICTION": 4, "CONVERSION_SUCCESS": 11,
                     "CART_REMOVED": 15, "DYNAMIC_PRICING": 352}
