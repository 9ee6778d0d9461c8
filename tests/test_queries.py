"""Every registered query against its SQL equivalent in DuckDB, and the shape of its plan."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from ledgerloom.plans import catalogue

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


SINGLE_ROW_JOINS = {"ops_dashboard_metrics"}  # counters of several tables side by side, one row each


def check_plan(name, df):
    """No query pairs all rows of two tables, and none leaves the JVM."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|PythonUDF|ArrowEval|MapInPandas|FlatMapGroups", plan)
    assert name in SINGLE_ROW_JOINS or "NestedLoopJoin" not in plan


def plain(value):
    if isinstance(value, Decimal):
        return value.normalize() + 0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def test_every_query_has_an_oracle():
    assert set(catalogue.REGISTRY) <= set(contract.queries()) and set(catalogue.REGISTRY) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalogue.REGISTRY))
def test_query_equals_oracle(spark, folder, duck, name):
    df = contract.queries()[name](spark, folder)
    check_plan(name, df)
    result = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    kinds = {c[0]: str(c[1]) for c in result.description}
    assert {c: TYPES.get(t, t.upper()) for c, t in df.dtypes} == kinds
    order = sorted(names)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in result.fetchall()), key=repr)
    assert got == want
    assert got, "a query that returns nothing checks nothing"


def test_entry(spark):
    assert contract.entry(spark).columns == ["ageing_bucket", "invoice_count", "total_due"]
