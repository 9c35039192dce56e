"""Every registered plan runs at sf0.001, names the same columns as its
oracle SQL (the driver sorts columns by name before hashing values), and
its executed plan has no sort aggregate, nested-loop join or Cartesian
product."""

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as E

from tracklake.plans.suite import QUERIES  # noqa: E402 - tests/llm has its own

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF001}/events.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_runs_and_matches_oracle_columns(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = df.collect()
    assert rows is not None
    plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    for op in ("SortAggregate", "NestedLoopJoin", "CartesianProduct"):
        assert op not in plan, f"{name}: {op}"
    if name in ORACLE:
        rel = con.sql(ORACLE[name])
        assert sorted(df.columns) == sorted(rel.columns)
        assert len(rows) == len(rel.fetchall())
