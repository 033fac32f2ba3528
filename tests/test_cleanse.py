import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import cleanse as c
from millrace.functions.ratios import percent, safe_ratio, sample_skew


def one(df):
    return tuple(df.first())


def test_unparsable_text_becomes_null_and_is_counted(spark):
    df = spark.createDataFrame([("x",), ("2026-13-01",), ("",), ("7",), (None,)], "s string")
    out = df.select(
        c.to_double("s"), c.to_int("s"), c.to_boolean("s"), c.to_date("s"), c.to_timestamp("s"), c.to_money("s"),
    ).collect()
    assert tuple(out[0]) == (None,) * 6
    assert tuple(out[1]) == (None,) * 6
    assert tuple(out[2]) == (None,) * 6
    assert out[3][0] == 7.0 and out[3][1] == 7 and out[3][5] == Decimal("7.00")
    lost = df.agg(F.count_if(c.lost_by_parsing("s", c.to_int("s")))).first()[0]
    assert lost == 3


def test_blank_flag_stays_unknown(spark):
    df = spark.createDataFrame([("True",), ("False",), (None,), ("true",)], "s string")
    assert [r[0] for r in df.select(c.to_boolean("s")).collect()] == [True, False, None, True]


def test_conforming(spark):
    df = spark.createDataFrame([(" leeds", "DELIVERED "), ("SOUTHAMPTON", " Delivered")], "a string, b string")
    out = df.select(c.conform_title("a"), c.conform_upper("b")).collect()
    assert [tuple(r) for r in out] == [("Leeds", "DELIVERED"), ("Southampton", "DELIVERED")]


def test_money_rounds_half_up_and_line_value_rounds_once(spark):
    df = spark.sql("select cast(1.005 as double) as x, 3 as q, cast(0.335 as decimal(10,3)) as p")
    assert one(df.select(c.as_money("x"), c.line_value("q", "p"))) == (Decimal("1.01"), Decimal("1.01"))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df.select(c.as_money(F.lit(1e12))).collect()


def test_minutes_count_boundaries(spark):
    df = spark.sql(
        "select timestamp'2026-01-01 00:00:50' as a, timestamp'2026-01-01 00:01:10' as b, "
        "timestamp'2026-01-01 00:01:59' as c")
    assert one(df.select(c.minutes_between("a", "b"), c.minutes_between("b", "c"), c.minutes_between("b", "a"))) == (1, 0, -1)


def test_comparison_of_money_is_three_valued(spark):
    df = spark.sql("select * from values (1.001, 1.004), (1.00, 1.01), (1.00, null) as t(a, b)")
    assert [r[0] for r in df.select(c.money_differs("a", "b")).collect()] == [False, True, None]
    assert [r[0] for r in df.select(c.is_true(c.money_differs("a", "b"))).collect()] == [False, True, False]


def test_ratios(spark):
    df = spark.sql("select * from values (1, 4), (1, 0), (1, null), (29, 1000), (1, 3), (1, 800) as t(n, d)")
    got = df.select(safe_ratio(F.col("n"), F.col("d")), percent(F.col("n"), F.col("d"))).collect()
    assert [r[0] for r in got][:3] == [0.25, 0.0, 0.0]
    # 1/800 is 0.125 %, which rounds up.
    assert [str(r[1]) for r in got] == ["25.00", "0.00", "0.00", "2.90", "33.33", "0.13"]


@pytest.mark.parametrize("values, want", [([1, 2, 2, 9], 1.9001), ([1, 2], None)])
def test_sample_skew(spark, values, want):
    got = spark.createDataFrame([(float(v),) for v in values], "x double").agg(sample_skew(F.col("x"))).first()[0]
    assert (got is None) if want is None else abs(got - want) < 5e-5


def test_timestamp_precision(spark):
    df = spark.sql("select timestamp_ntz'2026-01-01 01:02:03.123456' as t")
    assert one(df.select(c.to_microseconds("t"))) == (dt.datetime(2026, 1, 1, 1, 2, 3, 123456),)
