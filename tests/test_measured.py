"""Lists that were written and measured are sent to the rows, whatever Spark's own threshold; long ones are not."""

import pytest
from conftest import rows

from millrace.operators import joins, keys
from millrace.operators.tagging import survivors
from millrace.plans import silver
from millrace.sources.tables import settle


@pytest.fixture
def unsent(spark):
    """No table is small enough for Spark to broadcast it by itself."""
    conf = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in conf}
    for k in conf:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def lines(spark):
    return settle(spark.range(4000).selectExpr(
        "case when id % 50 = 3 then 'twice' || id % 200 when id % 400 <> 5 then 'l' || id end as order_line_id", "id % 500 as order_id",
        "if(id % 90 = 7, null, id % 31) as depot_id", "id % 40 as product_id", "date'2026-01-01' as requested_delivery_date",
        "cast(id % 10 as int) as quantity", "5.0D as unit_price"), "lines")


def test_repeated_keys_are_sent_and_long_lists_are_not(spark, unsent, monkeypatch):
    given = lines(spark)
    sent = keys.drop_identical_and_mark(given, ["order_line_id"])
    found = plan(sent)
    assert found.count("BroadcastHashJoin") >= 2 and "order_line_id" not in "".join(
        line for line in found.splitlines() if "SortMergeJoin" in line and ("LeftAnti" in line or "LeftSemi" in line))
    monkeypatch.setattr(joins, "SENT_BYTES", 100)
    moved = keys.drop_identical_and_mark(given, ["order_line_id"])
    assert "BroadcastHashJoin" not in plan(moved)
    assert rows(sent) == rows(moved) == rows(keys.mark_conflicts(keys.drop_identical(given), ["order_line_id"]))


def test_lines_move_for_their_product_only(spark, unsent, monkeypatch):
    """Copied, NULL and unknown depots: the verdicts are those of joins by key, and no line moves by its depot."""
    depots = settle(spark.range(60).selectExpr("if(id = 9, null, id % 25) as depot_id", "'x' as city"), "depots")
    products = settle(spark.range(30).selectExpr("id as product_id", "if(id = 4, 6.0D, 5.0D) as unit_price"), "products")
    given = lines(spark)
    sent = silver.tag_orders(given, depots, products)
    merged = [line for line in plan(sent.frame).splitlines() if "SortMergeJoin" in line]
    assert any("product_id" in line for line in merged) and not any("depot_id" in line for line in merged)
    monkeypatch.setattr(joins, "SENT_BYTES", 0)
    moved = silver.tag_orders(given, depots, products)
    assert any("depot_id" in line for line in plan(moved.frame).splitlines() if "SortMergeJoin" in line)
    assert rows(sent.frame) == rows(moved.frame)
    assert 0 < survivors(sent).count() < given.count()


def test_measured_size_counts_texts(spark, monkeypatch):
    monkeypatch.setattr(joins, "SENT_BYTES", 10_000)
    assert joins.sent_if_small(spark.range(50))._jdf.queryExecution().analyzed().toString().startswith("ResolvedHint")
    for long in (spark.range(200), spark.range(5).selectExpr("repeat('x', 3000) as k"), spark.range(5).selectExpr("array(id) as k")):
        assert joins.sent_if_small(long) is long
    empty = spark.range(0)
    assert joins.sent_if_small(empty).count() == 0
