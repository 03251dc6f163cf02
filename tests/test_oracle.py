"""Every registered query against its SQL, values and types."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from gapmend.plans.oracle import ORACLE_SQL
from gapmend.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"
TABLES = "orders lineitem events part documents labels"

# What a Spark type is called in DuckDB.
DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def in_order(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    order = frame.astype(str).sort_values(list(frame.columns)).index
    return frame.loc[order].reset_index(drop=True)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    wanted = duck.sql(ORACLE_SQL[name])
    types = {c: DUCK_TYPES[t] for c, t in found.dtypes}
    assert types == dict(zip(wanted.columns, map(str, wanted.types)))
    rows = in_order(found.toPandas())
    assert len(rows) > 0
    pd.testing.assert_frame_equal(rows, in_order(wanted.df()), check_dtype=False)


def test_entry(spark):
    assert entry.entry(spark).count() == 27
