"""Every query over the small sample tables against its SQL. One run is shared, as its staged
tables are what a real run shares between its steps."""

import contextlib
import io

import pytest
from check import connect, rows_of

from tidewatch import oracles, registry
from tidewatch.plans import patterns
from tidewatch.plans.graph_tables import graph_tables
from tidewatch.plans.pipeline import Run

SF_DIR = "/root/testdata/sf0.001"
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def run(spark):
    return Run.over_sample(spark, SF_DIR, registry.RAISED_AT)


@pytest.fixture(scope="module")
def graph(run):
    return patterns.Graph(graph_tables(run.table))


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def agree(df, con, name):
    plan = plan_of(df)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    result = con.execute(SQL[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_every_query_has_sql():
    assert set(registry.queries()) == set(SQL)


@pytest.mark.parametrize("name", registry.RUN_QUERIES)
def test_run_query(run, con, name):
    agree(registry.flat(registry.RUN_QUERIES[name](run)), con, name)


@pytest.mark.parametrize("name", registry.GRAPH_QUERIES)
def test_graph_query(graph, con, name):
    agree(registry.flat(registry.GRAPH_QUERIES[name](graph)), con, name)


@pytest.mark.parametrize("name", registry.SOURCE_QUERIES)
def test_source_query(spark, con, name):
    agree(registry.SOURCE_QUERIES[name](spark, SF_DIR), con, name)
