import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.plans import cube, measures
from millrace.sources.tables import settle


@pytest.fixture(scope="module")
def star(spark):
    """Lines whose orders span depots, lines without a parent, NULL keys and NULL members, ids over several buckets."""
    i = F.col("id")
    lines = spark.range(3000).select(
        i.alias("order_line_id"), F.when(i % 97 != 0, (i * 7919) % 100_000 - 20_000).alias("order_id"),
        F.when(i % 13 != 0, i % 9).alias("depot_id"), (i % 41).alias("product_id"),
        ((i % 700) * F.expr("0.25")).cast("decimal(12,2)").alias("line_value"))
    deliveries = spark.range(800).select(
        i.alias("delivery_id"), i.alias("order_id"), (i % 3 * 3).alias("depot_id"),
        F.when(i % 7 != 0, F.element_at(F.array(*map(F.lit, ("DELIVERED", "FAILED", "LATE"))), (i % 3 + 1).cast("int"))).alias("status"),
        F.when(i % 5 != 0, i % 2 == 0).alias("temperature_breach_flag"))
    depots = spark.range(7).select(i.alias("depot_id"), F.when(i != 4, F.concat(F.lit("R"), i % 2)).alias("region"),
                                   F.concat(F.lit("C"), i).alias("city"))
    products = spark.range(38).select(
        i.alias("product_id"), F.concat(F.lit("cat"), i % 4).alias("category"),
        F.concat(F.lit("z"), i % 3).alias("temperature_zone"), (i % 6 != 0).alias("is_active"))
    return {n: settle(df, n) for n, df in {"fact_orders": lines, "fact_deliveries": deliveries, "dim_depot": depots,
                                            "dim_product": products}.items()}


@pytest.fixture(scope="module")
def built(star):
    return settle(cube.build_cube(star), "cube")


def test_totals_equal_the_facts(star, built):
    assert rows(cube.totals(built)) == rows(measures.all_measures(star))


def test_every_question_equals_the_facts(star, built):
    members = {"region": ("R0", "nowhere"), "city": ("C5",), "category": ("cat1",), "temperature_zone": ("z2",),
               "status": ("FAILED", "DELIVERED", "none")}
    asked = [cube.Question(m, d, v, mode) for m in measures.MEASURES for d, vs in members.items() for v in vs
             for mode in (measures.OVERRIDE, measures.INTERSECT)]
    got = {r["place"]: r["value"] for r in cube.answers(built, asked).collect()}
    assert len(got) == len(asked)
    # One plan for each combination is slow: every measure meets every dimension once, the rate all of them.
    checked = [(i, q) for i, q in enumerate(asked)
               if q.measure == "Delivery Success Rate" and q.dimension == "status"
               or q.mode == measures.OVERRIDE and q.member in ("R0", "nowhere", "cat1", "FAILED")]
    for i, q in checked:
        plain = measures.query_metric(star, q.measure, {"dimension": q.dimension, "value": q.member}, filter_mode=q.mode)
        assert got[i] == plain.first()["value"], q


def test_members_equal_the_facts(star, built):
    asked = [("Total Revenue", "region"), ("Total Orders", "city"), ("Total Orders", "category"),
             ("Cold Chain Breaches", "status"), ("Active Products", "city"), ("Active Products", "category"),
             ("Delivery Success Rate", "region"), ("Total Deliveries", "temperature_zone")]
    got = cube.answers_by(built, asked)
    for m, d in asked:
        want = rows(measures.measure_by(star, m, d), "member", "value")
        assert rows(got.filter((F.col("measure") == m) & (F.col("dimension") == d)), "member", "value") == want, (m, d)


def test_loads_are_merged_without_their_facts(star, built):
    """Orders that come in both loads count once; the merge reads cubes alone."""
    parts = []
    for k in range(3):
        one = {n: df.filter(F.col("order_line_id" if n == "fact_orders" else "delivery_id") % 3 == k)
               for n, df in star.items() if n.startswith("fact")}
        whole = cube.build_cube({**star, **one})
        parts.append(settle(whole.filter(F.col("fact").startswith("fact") | F.lit(k == 0)), f"cube-{k}"))
    merged = settle(cube.merge(parts), "merged")
    plain = [c for c in merged.columns if c != "keys"]
    assert rows(merged, *plain) == rows(built, *plain)
    digest = [*cube.PLACE, F.sha2("keys", 256)]
    assert rows(merged, *digest) == rows(built, *digest)
    asked = cube.answers(merged, [cube.Question("Total Orders", "region", "R1")])
    plan = asked._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"FileScan parquet \[(.*?)\]", plan)
    assert len(read) == 1 and "n_keys#" in read[0] and ",keys#" not in read[0]


def test_repeated_dimension_keys_double_nothing(star, built):
    twice = {**star, "dim_depot": star["dim_depot"].unionByName(star["dim_depot"])}
    facts = built.filter("fact = 'fact_orders'").drop("keys")
    assert rows(cube.build_cube(twice).filter("fact = 'fact_orders'").drop("keys")) == rows(facts)


def test_empty_star(star):
    empty = {n: df.limit(0) for n, df in star.items()}
    made = settle(cube.build_cube(empty), "cube-empty")
    assert made.count() == 0
    assert {v for _, v in rows(cube.totals(made))} == {0.0}


def test_a_hot_member_is_spread_over_its_buckets(spark, star):
    """A third of all lines at one depot: its rows in the cube are one for each bucket of orders."""
    i = F.col("id")
    hot = spark.range(60_000).select(
        i.alias("order_line_id"), (i * 5).alias("order_id"), F.when(i % 3 == 0, 1).otherwise(i % 7).alias("depot_id"),
        (i % 38).alias("product_id"), F.lit(1).cast("decimal(12,2)").alias("line_value"))
    made = cube.build_cube({**star, "fact_orders": hot}).filter("fact = 'fact_orders' and member = 'C1'")
    per_bucket = made.agg(F.count(F.lit(1)).alias("b"), F.max("n_rows").alias("m"), F.sum("n_keys").alias("k")).first()
    want = hot.filter("depot_id = 1").count()
    assert per_bucket["k"] == want and per_bucket["b"] == 11 and per_bucket["m"] < want / 5


def test_requests_outside_the_allowed_set(star, built):
    for bad in (cube.Question("Profit"), cube.Question("Total Orders", "colour", "red"),
                cube.Question("Total Orders", mode="both")):
        with pytest.raises(measures.UnknownRequest):
            cube.answers(built, [bad])
    with pytest.raises(TypeError, match="integer keys"):
        cube.build_cube({**star, "fact_orders": star["fact_orders"].withColumn("order_id", F.col("order_id").cast("string"))})


def test_places_are_sorted_by_one_number(star):
    plan = cube.build_cube(star)._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line and "bucket" in line]
    assert sorts and all(re.search(r"Sort \[_place|Sort \[xxhash64|Sort \[_groupingexpression", line) for line in sorts), sorts
