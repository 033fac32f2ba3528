"""Members over loads, and rows judged by the state of their time."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import history
from millrace.plans import runs, silver
from millrace.session import work_folder
from millrace.sources.snapshots import SnapshotStore

DAYS = [dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1), dt.datetime(2022, 1, 1), dt.datetime(2023, 1, 1)]
LOADS = [[(1, 10, "a"), (2, 20, None), (3, 30, "c"), (None, 9, "x")], [(1, 10, "a"), (2, 21, None), (4, 40, "d")],
         [(1, 11, "a"), (2, 21, None)], [(1, 11, "a"), (2, 21, None), (3, 30, "c")]]


def built(spark):
    done = None
    for moment, load in zip(DAYS, LOADS):
        done = history.extend(done, spark.createDataFrame(load, "k int, price int, note string"), ["k"], moment)
    return done


def test_intervals(spark):
    a, b, c, d = DAYS
    assert rows(built(spark)) == sorted([
        (1, 10, "a", a, c), (1, 11, "a", c, None), (2, 20, None, a, b), (2, 21, None, b, None), (3, 30, "c", a, b),
        (3, 30, "c", d, None), (4, 40, "d", b, c)], key=repr)


def test_changes_and_members(spark):
    a, b, c, d = DAYS
    assert rows(history.changes(built(spark), ["k"])) == sorted([
        (1, a, "NEW"), (2, a, "NEW"), (3, a, "NEW"), (2, b, "CHANGED"), (3, b, "REMOVED"), (4, b, "NEW"), (1, c, "CHANGED"),
        (4, c, "REMOVED"), (3, d, "NEW")], key=repr)
    known = history.members_at(built(spark), ["k"], dt.datetime(2022, 6, 1))
    assert rows(known, "k", "price", "is_active") == [(1, 11, True), (2, 21, True), (3, 30, False), (4, 40, False)]
    assert history.members_at(built(spark), ["k"], dt.datetime(2019, 6, 1)).count() == 0


@pytest.mark.parametrize("days", [1, 30, 366, 10_000])
def test_rows_meet_the_state_of_their_time(spark, days):
    """Against a scan of all intervals; a third of the rows on one key, times at the very edges."""
    states = [tuple(r) for r in built(spark).collect()]
    moments = [*DAYS, dt.datetime(2019, 12, 31), dt.datetime(2020, 12, 31, 23, 59), dt.datetime(2026, 5, 5), None]
    given = [(n, (1, 1, 1, 2, 3, 4, 5, None)[n % 8], moments[n // 8 % 8]) for n in range(128)]
    lines = spark.createDataFrame(given, "id int, k int, t timestamp_ntz")
    got = history.as_of(lines, "k", "t", built(spark), "k", {"price": "then"}, days)

    def price(k, t):
        return next((p for key, p, _, f, e in states if key == k and t and f <= t and (e is None or t < e)), None)

    assert rows(got, "id", "then") == sorted(((n, price(k, t)) for n, k, t in given), key=repr)
    plan = got._jdf.queryExecution().toString()
    assert "Window" not in plan
    assert history.as_of(lines.limit(0), "k", "t", built(spark), "k", {"price": "then"}).columns == ["id", "k", "t", "then"]


def test_a_master_is_loaded_in_order_and_once(spark):
    store = SnapshotStore(spark, work_folder(spark, "master"))
    load = spark.createDataFrame([(1, 5)], "product_id int, unit_price int")
    one = silver.load_master(store, load, runs.Run("a"), DAYS[1])
    assert silver.load_master(store, load.limit(0), runs.Run("a"), DAYS[2]).version == one.version == 1
    with pytest.raises(ValueError, match="comes after"):
        silver.load_master(store, load, runs.Run("b"), DAYS[0])
    gone = silver.load_master(store, load.limit(0), runs.Run("c"), DAYS[3])
    assert rows(gone.table(silver.HISTORY), "valid_from", "valid_to") == [(DAYS[1], DAYS[3])]
    assert one.table(silver.HISTORY).filter("valid_to is null").count() == 1


def test_cut_intervals_are_broadcast_by_their_own_size(spark):
    """Intervals of 400 days cut by the day are 400 times the history: no estimate says so, and the driver must not get them."""
    states = spark.range(1_000).selectExpr(
        "id as k", "cast(id as double) as price", "timestamp_ntz'2020-01-01 00:00:00' as valid_from",
        "cast(null as timestamp_ntz) as valid_to")
    lines = spark.range(4_000).selectExpr(
        "id % 1000 as k", "id", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id % 400 as int)) as t")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
    try:
        for days, broadcast in ((1, False), (366, True)):
            met = history.as_of(lines, "k", "t", states, "k", {"price": "then"}, days).agg(
                F.count("then").alias("n"), F.count_if(F.col("then") == F.col("k")).alias("right"))
            assert [tuple(row) for row in met.collect()] == [(4_000, 4_000)]
            plan = met._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert ("BroadcastHashJoin" in plan) == broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
