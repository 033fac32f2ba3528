"""Registered queries against their SQL in DuckDB.

All of them run with MILLRACE_ALL=1; by default a selection that touches every module.
"""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as spark_entry
from millrace.catalog.base import REGISTERED

FOLDER = "/root/testdata/sf0.001"
SELECTION = [
    "scan_raw_csv", "parse_timestamp", "rule_null_warn", "key_integrity", "fk_report", "rule_results", "gate",
    "quarantine", "silver_deliveries", "dim_product", "run_tests", "all_measures", "query_metric", "metric_from_cube",
    "members_from_cube", "measure_cube",
    "revenue_by_region", "numeric_profile", "drift_soft", "grounding_check", "inject_ghost_rows", "stream_bronze",
]


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("key", sorted(REGISTERED) if os.environ.get("MILLRACE_ALL") else SELECTION)
def test_query_matches_sql(spark, duck, key):
    assert compare(spark, duck, REGISTERED[key], FOLDER) == ""


def test_every_query_has_a_callable_and_sql():
    own = set(REGISTERED)
    assert own & set(spark_entry.oracle_sql()) == own & set(spark_entry.queries()) == own
    assert spark_entry.queries()["gate"]


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() == 5
