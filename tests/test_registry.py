"""Every registered query against its SQL, and the plans it must not have."""

import re

import pytest

import __spark_entry__ as contract
from tests.compare import connect, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"
# Queries of this library's own registry; additional packages test theirs.
QUERIES = {name: run for name, run in contract.queries().items() if getattr(run, "module", "").startswith("registry.")}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}
# Results that depend on the order of floating-point work or on an iterative fit.
NO_SQL = {"grouped_kmeans", "elbow_by_count", "silhouette_by_count", "pca_2d", "clusters_labelled"}


@pytest.fixture(scope="module")
def base():
    return connect(FOLDER)


def test_only_fits_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, base, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    names, _, found = spark_rows(df)
    expected_names, _, expected = sql_rows(base, ORACLES[name])
    assert names == expected_names
    assert found == expected


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_fit_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_flagship_entry(spark):
    assert contract.entry(spark).count() > 0


def scan(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_filters_and_columns_reach_the_scan(spark):
    lineitem = [s for s in scan(spark, "backfill_update") if "l_orderkey" in s]
    assert all("EqualTo(l_returnflag,R)" in s for s in lineitem)
    assert all("ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,"
               "l_returnflag:string>" in s for s in lineitem)
    narrow = scan(spark, "submission_fact")
    assert narrow and not any("l_extendedprice" in s for s in narrow)


def test_pivot_needs_one_shuffle(spark):
    plan = QUERIES["category_pivot_wide"](spark, FOLDER)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "partial_min_by" in text
