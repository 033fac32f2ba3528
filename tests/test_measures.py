import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import checks, drills
from millrace.plans import explain, gold, measures, monitor, reports
from millrace.plans import silver as plan


@pytest.fixture(scope="module")
def star(spark):
    lines = spark.sql("""
        select * from values
          ('a-1', 'a', 'c1', 'd1', 'p1', 10.00), ('a-2', 'a', 'c1', 'd1', 'p2', 5.00),
          ('b-1', 'b', 'c2', 'd2', 'p1', 20.00), ('c-1', 'c', 'c2', 'd3', 'p9', 1.00)
        as t(order_line_id, order_id, customer_id, depot_id, product_id, line_value)""")
    deliveries = spark.sql("""
        select * from values
          ('x', 'a', 'd1', 'DELIVERED', true, 1.0, 60), ('y', 'b', 'd2', 'FAILED', null, 2.0, 30),
          ('z', 'c', 'd2', 'DELIVERED', false, 3.0, 90), ('w', 'c', 'd1', 'DELIVERED', false, 3.0, 100)
        as t(delivery_id, order_id, depot_id, status, temperature_breach_flag, distance_km, transit_minutes)""")
    depots = spark.sql("select * from values ('d1', 'North', 'Leeds'), ('d2', 'South', 'Hove') as t(depot_id, region, city)")
    products = spark.sql("""
        select * from values ('p1', 'Chilled', 'COLD', true), ('p2', 'Frozen', 'ICE', true), ('p9', 'Frozen', 'ICE', false)
        as t(product_id, category, temperature_zone, is_active)""")
    return {"fact_orders": lines, "fact_deliveries": deliveries, "dim_depot": depots, "dim_product": products}


def ask(star, measure, dimension=None, value=None, **kw):
    f = {"dimension": dimension, "value": value} if dimension else None
    return measures.query_metric(star, measure, f, **kw).first()["value"]


def test_unfiltered_measures(star):
    assert dict(rows(measures.all_measures(star))) == {
        "Total Revenue": 36.0, "Total Orders": 3.0, "Order Lines": 4.0, "Avg Line Value": 9.0, "Active Products": 2.0,
        "Total Deliveries": 4.0, "Delivery Success Rate": 0.75, "Cold Chain Breaches": 1.0}
    for name in measures.MEASURES:
        assert measures.evaluate(star, name).first()["value"] == dict(rows(measures.all_measures(star)))[name]


# Which filter reaches which measure; None stands for the unfiltered value.
@pytest.mark.parametrize("dimension, value, want", [
    ("region", "North", {"Total Revenue": 15.0, "Order Lines": 2.0, "Active Products": None, "Total Deliveries": 2.0,
                         "Delivery Success Rate": 1.0}),
    ("city", "Hove", {"Total Orders": 1.0, "Cold Chain Breaches": 0.0, "Delivery Success Rate": 0.5}),
    ("category", "Frozen", {"Total Revenue": 6.0, "Avg Line Value": 3.0, "Active Products": 1.0, "Total Deliveries": None,
                            "Cold Chain Breaches": None}),
    ("temperature_zone", "COLD", {"Total Revenue": 30.0, "Active Products": 1.0}),
    ("status", "FAILED", {"Total Revenue": None, "Active Products": None, "Total Deliveries": 1.0, "Cold Chain Breaches": 0.0}),
    ("region", "Nowhere", {"Total Revenue": 0.0, "Avg Line Value": 0.0, "Delivery Success Rate": 0.0}),
])
def test_filter_context(star, dimension, value, want):
    plain = dict(rows(measures.all_measures(star)))
    for measure, expected in want.items():
        assert ask(star, measure, dimension, value) == (plain[measure] if expected is None else expected), measure


def test_status_filter_on_success_rate(star):
    assert ask(star, "Delivery Success Rate", "status", "FAILED") == 3.0
    assert ask(star, "Delivery Success Rate", "status", "FAILED", filter_mode="intersect") == 0.0
    assert ask(star, "Delivery Success Rate", "status", "DELIVERED") == 1.0


def test_requests_outside_the_contract_are_rejected(star):
    for bad in (lambda: ask(star, "Profit"), lambda: ask(star, "Total Revenue", "customer_id", "c1"),
                lambda: measures.query_metric(star, "Total Revenue", {"dimension": "region"}),
                lambda: ask(star, "Total Revenue", filter_mode="other"), lambda: measures.measure_by(star, "Profit", "region")):
        with pytest.raises(measures.UnknownRequest):
            bad()


def test_measure_by_dimension(star):
    assert rows(measures.measure_by(star, "Total Revenue", "region")) == sorted(
        [("North", 15.0), ("South", 20.0), (None, 1.0)], key=repr)
    assert rows(measures.measure_by(star, "Active Products", "city")) == [("Hove", 2.0), ("Leeds", 2.0)]
    assert rows(measures.measure_by(star, "Total Deliveries", "status")) == [("DELIVERED", 3.0), ("FAILED", 1.0)]


def test_audit_appends(star, tmp_path):
    f = {"dimension": "status", "value": "FAILED"}
    measures.audit(measures.query_metric(star, "Order Lines"), None, path=str(tmp_path))
    log = measures.audit(measures.query_metric(star, "Total Deliveries", f), f, path=str(tmp_path))
    assert rows(log, "measure", "dimension", "filter_value", "value") == [
        ("Order Lines", None, None, 4.0), ("Total Deliveries", "status", "FAILED", 1.0)]


def test_questions_are_matched_in_normal_form(spark, star):
    asked = spark.createDataFrame([("What share of  deliveries succeeds?!",), ("What is love?",)], "q string")
    got = rows(measures.answer_questions(asked, "q", star), "q", "measure", "value")
    assert got == sorted([("What share of  deliveries succeeds?!", "Delivery Success Rate", 0.75),
                          ("What is love?", None, None)], key=repr)


def test_kpis(star):
    exec_row = reports.kpi_exec(star).first()
    assert (float(exec_row["revenue"]), exec_row["orders"], exec_row["customers"], exec_row["avg_line_value"],
            exec_row["active_products"], exec_row["product_categories"], exec_row["withdrawn_products"]) == (
        36.0, 3, 2, 9.0, 2, 2, 1)
    ops = reports.kpi_ops(star["fact_deliveries"], star["fact_deliveries"]).first()
    assert (ops["delivered"], str(ops["delivered_pct"]), ops["failed"], ops["avg_transit"], ops["unknown_breaches"]) == (
        3, "75.00", 1, 70.0, 1)
    shares = {r["status"]: r["share"] for r in reports.status_mix(star["fact_deliveries"]).collect()}
    assert shares == {"DELIVERED": 0.75, "FAILED": 0.25}
    regions = [r["region"] for r in reports.revenue_by_region(star).collect()]
    assert regions == ["South", "North", None]


def test_table_tests_turn_red_and_green(spark, star):
    tests = [checks.TableTest("unique", "fact_orders", "order_line_id"), checks.TableTest("not_null", "fact_orders", "depot_id"),
             checks.TableTest("relationships", "fact_orders", "depot_id", "dim_depot", "depot_id"),
             checks.TableTest("rows", "fact_orders", "line_value", bad=F.col("line_value") <= 0)]
    green = {r["test"]: r["failures"] for r in checks.run_tests(tests, star).collect()}
    assert green == {"unique": 0, "not_null": 0, "relationships": 1, "rows": 0}
    hurt = drills.repeat_rows(star["fact_orders"], F.col("order_id") == "a")
    hurt = drills.blank(hurt, "depot_id", F.col("order_id") == "c")
    hurt = drills.flip_sign(hurt, "line_value", F.col("order_id") == "b")
    red = {r["test"]: r["failures"] for r in checks.run_tests(tests, {**star, "fact_orders": hurt}).collect()}
    # A NULL child is no broken relationship.
    assert red == {"unique": 2, "not_null": 1, "relationships": 0, "rows": 1}
    with pytest.raises(checks.TestsFailed, match="relationships fact_orders.depot_id: 1"):
        checks.block_on_failure(checks.run_tests(tests, star))
    phases = checks.summary(drills.sabotage(tests, star, {**star, "fact_orders": hurt}).filter("phase = 'sabotaged'"))
    assert rows(phases) == [("FAIL", 3, 4), ("PASS", 1, 0)]


def test_withdrawn_products_return_even_beside_a_null_key(spark):
    bronze = spark.createDataFrame([(k, "n", "c", "z", 2.0, 3.0, 5) for k in ("p1", "p2", "p2")],
                                   "product_id string, product_name string, category string, temperature_zone string, "
                                   "unit_cost double, unit_price double, shelf_life_days int")
    silver = bronze.filter("product_id = 'p1'").unionByName(bronze.limit(1).withColumn("product_id", F.lit(None).cast("string")))
    dim = gold.dim_product(silver, bronze)
    assert rows(dim, "product_id", "is_active") == sorted([("p1", True), (None, True), ("p2", False)], key=repr)


def test_cascade_and_escalation(spark):
    raw = spark.createDataFrame([("p", 10.0, 9.0), ("q", 5.0, 6.0)], "product_id string, unit_cost double, unit_price double")
    kept = plan.survivors(plan.tag_products(raw))
    orders = spark.createDataFrame([("1", "p", 12.0), ("2", "q", 7.0), ("3", "q", 6.0)],
                                   "order_line_id string, product_id string, unit_price double")
    assert rows(plan.cascade_report(orders, raw, kept)) == [("CASCADE", 1), ("GENUINE", 1)]


def test_monitoring(spark):
    log = spark.sql("""
        select 'orders' as table, date_add(date'2026-01-01', d) as run_date, cast(100 as bigint) as rows_in,
               cast(v as bigint) as violations
        from values (0, 3), (1, 3), (2, 3), (3, 6), (20, 4) as t(d, v)""")
    rates = monitor.quarantine_rate(log)
    assert [str(r[0]) for r in monitor.drift_hard(rates).select("run_date").collect()] == ["2026-01-04"]
    assert [str(r[0]) for r in monitor.drift_soft(rates).select("run_date").collect()] == ["2026-01-04"]
    runs = spark.sql("select timestamp'2026-01-01 00:00:00' as started_at, timestamp'2026-01-01 00:31:00' as finished_at")
    assert monitor.refresh_latency(runs).first()["status"] == "WARN"
    assert monitor.refresh_latency(runs, 31).first()["status"] == "PASS"


def test_grounding(spark):
    text = "Success held at 88% this period, below the 0.90 baseline, with 311 failed and 1,000.5 late runs."
    df = spark.createDataFrame([(text, [0.88, 0.90])], "t string, given array<double>")
    strict = explain.grounding_check(df, "t", F.col("given")).first()
    assert (sorted(strict["ungrounded"]), strict["n_figures"], strict["status"]) == (["1000.5", "311", "88"], 4, "FAIL")
    loose = explain.grounding_check(df, "t", F.col("given"), percent_form=True).first()
    assert sorted(loose["ungrounded"]) == ["1000.5", "311"]
    nothing = explain.grounding_check(df, "t", F.lit(None).cast("array<double>")).first()
    assert nothing["status"] == "FAIL" and len(nothing["ungrounded"]) == 4
    values = spark.createDataFrame([("Total Orders", 5962.0)], "measure string, value double")
    line = explain.explain_context(values, values, "July").first()["context"]
    assert line == "Total Orders = 5962.00 for July; baseline 5962.00"


def test_figures_are_derived_or_named(spark):
    """311 and 211 are not given; their difference, their sum and a share are."""
    text = "Failures fell from 311 to 211, by 100 or 32.2%, of 522 in all; 67.85% of them, a ratio of 0.678, and 77 more."
    df = spark.createDataFrame([(text, [311.0, 211.0]), (text, [5.0]), ("none", None), ("0 of 0.00", [0.0])], "t string, given array<double>")
    got = explain.derivation_check(df, "t", F.col("given")).collect()
    assert {x["figure"]: x["how"] for x in got[0]["figures"]} == {
        "311": "given", "211": "given", "100": "difference", "32.2": "unknown", "522": "sum", "67.85": "percent", "0.678": "ratio",
        "77": "unknown"}
    assert [r["status"] for r in got] == ["FAIL", "FAIL", "PASS", "PASS"]
    assert {x["how"] for x in got[1]["figures"]} == {"unknown"}
