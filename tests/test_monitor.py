"""Monitoring over runs, and master data with conflicting keys."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import references
from millrace.operators.rules import RowRule
from millrace.operators.tagging import tag
from millrace.operators.gate import ContractViolation
from millrace.plans import gold, monitor, runs, silver
from millrace.session import work_folder
from millrace.sources.retail import RetailTables
from millrace.sources.snapshots import SnapshotStore


def test_orphans_are_compared_with_the_run_before(spark):
    days = [dt.date(2026, 1, d) for d in (1, 2, 3)]
    lines = spark.createDataFrame(
        [(days[0], 9)] * 5 + [(days[1], 1)] * 5 + [(days[2], 9)] * 4 + [(days[2], 8)], "day date, depot int")
    depots = spark.createDataFrame([(1,)], "depot int")
    loose = references.orphans(lines, "depot", depots, "depot")
    got = monitor.orphan_increase(lines, loose, "depot", F.col("day"), "R7")
    assert rows(got, "run_date", "orphans", "new_bad_keys", "previous", "increase") == sorted(
        [(days[0], 5, 1, 0, 5), (days[1], 0, 0, 5, -5), (days[2], 5, 1, 0, 5)], key=repr)


def test_rows_without_a_day_keep_their_violations(spark):
    df = spark.createDataFrame([(None, -1), (dt.date(2026, 1, 1), 1)], "day date, n int")
    judged = tag(df, "t", [RowRule("X", "n", "above zero", bad=F.col("n") <= 0)])
    log = runs.backfill(df, judged, F.col("day"))
    assert rows(runs.loads(log), "run_date", "rows_in", "violations") == sorted(
        [(None, 1, 1), (dt.date(2026, 1, 1), 1, 0)], key=repr)


PRODUCTS = "product_id int, product_name string, category string, temperature_zone string, unit_cost decimal(10,2)," \
           " unit_price decimal(10,2), shelf_life_days int"


def _products(spark):
    return spark.createDataFrame([(1, "a", "c", "z", 1, 2, 5), (1, "a", "c", "z", 1, 2, 6), (2, "b", "c", "z", 1, 3, 5)],
                                 ", ".join(f"{c.split()[0]} {'int' if 'decimal' in c else c.split()[1]}"
                                           for c in PRODUCTS.replace("(10,2)", "").split(",")))


def test_a_conflicting_key_comes_back_once(spark):
    raw = _products(spark)
    kept = raw.filter("product_id = 2")
    assert rows(gold.dim_product(kept, raw), "product_id", "shelf_life_days", "is_active") == [(1, 5, False), (2, 5, True)]


def test_cascade_counts_a_line_once(spark):
    raw = _products(spark)
    lines = spark.createDataFrame([(1, 9), (2, 9), (2, 3)], "product_id int, unit_price int")
    got = silver.cascade_report(lines, raw, raw.filter("product_id = 2"))
    assert rows(got) == [("CASCADE", 1), ("GENUINE", 1)]


def test_fk_report_with_a_hot_parent(spark):
    child = spark.createDataFrame([(1,), (1,), (7,), (None,)], "k int")
    parent = spark.range(50).selectExpr("cast(1 as int) as k")
    got = references.fk_report(child, "k", parent, "k", "x").first()
    assert (got["orphans"], got["distinct_bad_keys"], got["first_bad_keys"], float(got["orphan_pct"])) == (1, 1, "7", 33.33)


def test_every_load_is_logged_also_a_halted_one(spark):
    raw = silver.conform(RetailTables(spark, "/root/testdata/sf0.001").all)
    path = work_folder(spark, "store")
    run = silver.publish_silver(raw, "log_", location=path, run=runs.Run("one", dt.date(2026, 1, 1)))
    with pytest.raises(ContractViolation):
        silver.publish_silver(raw, "log_", 1.0, location=path, run=runs.Run("two", dt.date(2026, 1, 2)))
    state = SnapshotStore(spark, path).latest()
    log = state.table(runs.RUN_LOG)
    assert rows(log.groupBy("run_id", "status").count()) == [("one", "PASS", 12), ("two", "HALT", 12)]
    assert rows(state.table(runs.RUN_LOG, since=1).select("run_id").distinct()) == [("two",)]
    for table in silver.GATED:
        mine = log.filter((F.col("run_id") == "one") & (F.col("table") == table))
        read, removed, rejected = mine.agg(F.max("rows_in"), F.max("identical_removed"), F.sum("rows_rejected")).first()
        assert read - removed - rejected == run.tables[table].count() and read == raw[table].count()
    rates = monitor.quarantine_rate(runs.loads(log))
    assert rates.count() == 6 and monitor.drift_hard(rates, 1.0).count() > 0
    assert rows(monitor.refresh_latency(runs.durations(log)), "run_id", "status") == [("one", "PASS"), ("two", "PASS")]


def test_a_repeated_load_changes_nothing(spark):
    raw = silver.conform(RetailTables(spark, "/root/testdata/sf0.001").all)
    path, one = work_folder(spark, "store"), runs.Run("one", dt.date(2026, 1, 1))
    first = silver.publish_silver(raw, "again_", location=path, run=one, append=("orders",))
    again = silver.publish_silver({**raw, "orders": raw["orders"].limit(5)}, "again_", location=path, run=one, append=("orders",))
    assert again.snapshot.version == first.snapshot.version == 1
    assert rows(again.results, "rule", "violations") == rows(first.results, "rule", "violations")
    more = silver.publish_silver(raw, "again_", location=path, run=runs.Run("two"), append=("orders",))
    assert more.tables["orders"].count() == 2 * first.tables["orders"].count()
    assert more.tables["products"].count() == first.tables["products"].count()
    for _ in range(2):
        with pytest.raises(ContractViolation):
            silver.publish_silver(raw, "again_", 1.0, location=path, run=runs.Run("three"))
    assert SnapshotStore(spark, path).versions() == [1, 2, 3]
