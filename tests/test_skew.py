"""A third of all rows on one key: the plan splits them, and no result changes."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import gate, history, keys, references
from millrace.operators.quantiles import exact_quantiles, to_long
from millrace.operators.tagging import rejected, survivors
from millrace.plans import silver


@pytest.fixture
def splitting(spark):
    """Thresholds small enough that test data counts as large and skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=120_000):
    """Every third row has key 7."""
    return spark.range(n, numPartitions=8).selectExpr("if(id % 3 = 0, 7, id) as k", "id as v")


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    counted = df.groupBy().agg(F.count("*"), F.sum("v"))
    counted.collect()
    return counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_parent_marker_splits_a_hot_key(spark, splitting):
    parents = spark.range(0, 120_000, 2).selectExpr("id as p").unionByName(spark.range(7, 9).selectExpr("id as p"))
    marked = references.mark_parent(hot(spark), "k", parents, "p", "hit")
    assert "skew=true" in final_plan(marked.filter("hit or v > 0"))
    assert marked.count() == 120_000


def test_conflict_marker_splits_a_hot_key(spark, splitting):
    marked = keys.mark_conflicts(keys.drop_identical(hot(spark)), ["k"])
    plan = final_plan(marked.withColumn("v", F.when(F.col(keys.CONFLICT), F.col("v")).otherwise(0)))
    assert "skew=true" in plan
    assert marked.filter(keys.CONFLICT).count() == 40_000 + 1 - (1 if 7 % 3 == 0 else 0)


def test_first_time_join_splits_a_hot_key(spark, splitting):
    starts = spark.range(0, 120_000).selectExpr("id as k", "id as at")
    joined = references.precedes_first(hot(spark), "k", "v", starts, "at")
    assert "skew=true" in final_plan(joined.filter("too_early or v >= 0"))


def test_copies_shrink_before_the_shuffle(spark):
    copies = spark.range(200_000, numPartitions=8).selectExpr("cast(if(id % 3 < 2, 1, id) as bigint) as k", "1 as v")
    plan = keys.drop_identical(copies)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Exchange")
    assert "HashAggregate" in plan[partial:], "no map-side step below the shuffle"


def test_quantile_state_is_bounded_and_exact_under_ties(spark):
    n = 90_000
    df = spark.range(n, numPartitions=8).selectExpr("if(id % 3 = 0, 500.0D, cast(pmod(hash(id), 100003) as double)) as x")
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(to_long(df, ["x"]), [0.05, 0.5, 0.95], 200).collect()}
    want = df.agg(F.percentile("x", F.array(*[F.lit(p) for p in (0.05, 0.5, 0.95)]))).first()[0]
    assert [got[0.05], got[0.5], got[0.95]] == want


def test_gate_on_hot_keys_equals_brute_force(spark, splitting):
    """A third of the lines are copies of one row; another third share product, depot and line id but differ."""
    lines = spark.range(45_000, numPartitions=6).selectExpr(
        "case id % 3 when 0 then 'copy' when 1 then 'clash' else concat('l', id) end as order_line_id",
        "if(id % 3 = 0, 0, id) as order_id", "if(id % 3 = 2, id % 50, 1) as depot_id",
        "if(id % 3 = 2, id % 40, 1) as product_id",
        "if(id % 3 = 0, null, date'2026-01-01') as requested_delivery_date",
        "cast(if(id % 3 = 0, 1, id % 10) as int) as quantity", "cast(if(id % 30 = 2, 9, 5) as double) as unit_price")
    depots = spark.range(0, 45).selectExpr("id as depot_id")
    products = spark.range(0, 30).selectExpr("id as product_id", "5.0D as unit_price", "if(id = 9, 6.0D, 1.0D) as unit_cost")
    judged = silver.tag_orders(lines, depots, survivors(silver.tag_products(products)))
    got = {r["rule"]: (r["violations"], r["rows_rejected"]) for r in gate.rule_results([judged]).collect()}

    local = {tuple(r) for r in lines.collect()}
    ids = [r[0] for r in local]
    clash = {i for i in ids if i == "clash" and ids.count(i) > 1} if "clash" in ids else set()
    left = [r for r in local if r[0] not in clash]
    known = {p for p in range(30) if p != 9}
    want = {"R4": (len(clash), len(local) - len(left)), "R5": (sum(r[4] is None for r in left), 0)}
    for rule, bad in (("R6", lambda r: r[5] <= 0), ("R7", lambda r: r[2] >= 45),
                      ("R8", lambda r: r[3] in known and r[6] != 5.0)):
        wrong = [r for r in left if bad(r)]
        want[rule] = (len(wrong), len(wrong))
        left = [r for r in left if not bad(r)]
    want["R17"] = (sum(r[3] not in known for r in left), 0)
    assert got == want
    assert survivors(judged).count() == len(left)
    assert rejected(judged).count() + len(left) == len(local)


def test_as_of_join_splits_a_hot_key(spark, splitting):
    at = "timestamp_ntz'2020-01-01 00:00:00'"
    states = spark.range(0, 120_000).selectExpr("id as p", "id as price", f"{at} as valid_from", "cast(null as timestamp_ntz) as valid_to")
    priced = history.as_of(hot(spark).selectExpr("*", f"{at} as t"), "k", "t", states, "p", {"price": "then"})
    assert "skew=true" in final_plan(priced.filter("then = k or v > 0"))
    assert priced.filter("then = k").count() == 120_000
