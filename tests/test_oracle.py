"""Every registered query against its SQL, all rows and values."""

import pytest
from comparing import connect, spark_result, sql_result
from conftest import SF_DIR

import __spark_entry__ as entry_points
from salesmart import oracle
from salesmart.plans import catalog

QUERIES = catalog.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


SQL_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    sql_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == sql_types
    columns, rows = spark_result(df)
    assert rows
    sql_columns, sql_rows = sql_result(con, ORACLE[name])
    assert columns == sql_columns
    assert len(rows) == len(sql_rows)
    assert rows == sql_rows


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
