"""Plan-level guards over every registered query (sf0.001)."""

import pytest

import __spark_entry__ as E
from pulsewatch.plans import catalog
from tests.conftest import SF_SMALL

FORBIDDEN = [
    "BatchEvalPython", "ArrowEvalPython", "PythonUDF",      # no Python in the hot path
    "CartesianProduct", "BroadcastNestedLoopJoin",          # no all-pairs joins
]


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in E.queries().items():
        if name not in catalog.QUERIES:
            continue
        out[name] = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_python_udf_or_all_pairs_join(plans):
    bad = {n: [f for f in FORBIDDEN if f in p] for n, p in plans.items()}
    assert not {n: f for n, f in bad.items() if f}


# These add each range's first row number: one row per range, whatever the table holds.
INDEXED = {"union_indexed", "appended_index", "csv_indexed", "time_sorted", "paired_global", "attackers_retimed"}


def test_no_static_broadcast(plans):
    """Broadcasts are decided by AQE on measured sizes, not by estimates."""
    assert not [n for n, p in plans.items() if "BroadcastExchange" in p and n not in INDEXED]


def test_no_row_number_goes_through_one_task(plans):
    assert not [n for n in INDEXED if "SinglePartition" in plans[n]]


def test_histories_are_limited_before_the_shuffle(plans):
    plan = plans["user_histories"]
    assert plan.index("WindowGroupLimit") < plan.index("hashpartitioning(user_id") < plan.rindex("WindowGroupLimit")


def test_scans_are_pruned(plans):
    """A query that needs few columns reads few: ReadSchema lists only them."""
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plans["views_per_minute"]
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in plans["views_per_minute"]
