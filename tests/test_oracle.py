"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from aeromart.plans import registry
from tests.conftest import plan

FOLDER = "/root/testdata/sf0.001"

# Queries that run a load when called; their result is a plain read of what was written.
EAGER = {
    "refresh_locations", "refresh_parameters", "landing_files", "staging_truncates",
    "fact_partitions", "load_range", "load_windows", "load_reports", "stream_load",
    "daily_alert_run", "whole_run", "alerts_from_partials", "load_log", "load_missing", "replay_quarantine",
    "alert_newest_stored_day",
}


@pytest.fixture(scope="module")
def duck():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_equals_sql(spark, duck, name):
    assert check.compare(spark, duck, name, FOLDER).startswith("equal")


def test_entry_has_rows(spark):
    assert entry(spark).columns == [
        "country_code", "measure_date", "parameter_code", "avg_value", "base_value"
    ]
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert registry.QUERIES.keys() == registry.SQL.keys()
    assert queries().keys() >= oracle_sql().keys() >= registry.SQL.keys()


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in EAGER])
def test_no_python_in_any_plan(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in text
