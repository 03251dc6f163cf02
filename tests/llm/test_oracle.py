"""Queries against their SQL, values and types."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from gapmend.llm.oracle import ORACLE_SQL
from gapmend.llm.queries import QUERIES
from tests.test_oracle import DUCK_TYPES, in_order

SF = "/root/testdata/sf0.01"


def test_registered(spark):
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in QUERIES) == 1 for n in names)
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found, wanted = QUERIES[name](spark, SF), duck.sql(ORACLE_SQL[name])
    types = {c: {"boolean": "BOOLEAN", **DUCK_TYPES}[t] for c, t in found.dtypes}
    assert types == dict(zip(wanted.columns, map(str, wanted.types)))
    rows = in_order(found.toPandas())
    assert len(rows) == 1000
    pd.testing.assert_frame_equal(rows, in_order(wanted.df()), check_dtype=False)
