import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import profile
from millrace.operators.aggregates import order_header, top_k, with_share
from millrace.operators.references import membership_changes


def test_numeric_profile_against_numpy(spark):
    values = np.random.default_rng(5).normal(10, 4, 2000).round(3)
    df = spark.createDataFrame([(float(v), None) for v in values] + [(None, None)], "x double, gone double")
    row = profile.numeric_profile(df).filter("column = 'x'").first()
    want = np.percentile(values, [5, 50, 95])
    assert np.allclose([row["p05"], row["median"], row["p95"]], want)
    assert (row["min"], row["max"], row["n_negative"], row["n_zero"]) == (
        values.min(), values.max(), int((values < 0).sum()), int((values == 0).sum()))
    assert abs(float(row["mean"]) - values.mean()) < 0.01
    empty = profile.numeric_profile(df).filter("column = 'gone'").first()
    assert empty["median"] is None and empty["n_zero"] == 0


def test_histogram_holds_every_value(spark):
    df = spark.range(1001).selectExpr("cast(id as int) as x", "7 as flat")
    bins = profile.histogram(df, ["x", "flat"])
    per = {r["column"]: r["n"] for r in bins.groupBy("column").agg(F.sum("n").alias("n")).collect()}
    assert per == {"x": 1001, "flat": 1001}
    assert rows(bins.filter("column = 'flat'"), "bin", "low", "median") == [(0, 7.0, 7.0)]
    assert bins.filter("column = 'x'").agg(F.max("bin")).first()[0] == 44


def test_schema_audit_exact_and_approximate_agree_on_small_data(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("a", 3)], "s string, n int")
    want = [("t", "n", "int", 2, 1, "33.33", 2, "1"), ("t", "s", "string", 3, 0, "0.00", 2, "a")]
    for approximate in (False, True):
        got = profile.schema_audit(df, "t", approximate)
        assert rows(got.withColumn("null_pct", F.col("null_pct").cast("string"))) == want


def test_missingness(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", None, None)], "s string, gone string, n int")
    assert [r["column"] for r in profile.missingness(df, "t").collect()] == ["gone", "n"]
    assert rows(profile.missingness_by(df, "n", "s"), "s", "nulls") == [("a", 0), ("b", 1)]


def test_categorical_profile_keeps_every_value(spark):
    df = spark.range(100).selectExpr("cast(id as string) as wide", "if(id < 70, 'x', if(id < 99, 'y', null)) as slim")
    got = profile.categorical_profile(df, ["wide", "slim"])
    wide = [("wide", 100, k + 1, v, 1) for k, v in enumerate(sorted(str(n) for n in range(100)))]
    assert rows(got) == sorted([("slim", 2, 1, "x", 70), ("slim", 2, 2, "y", 29), ("slim", 2, 3, None, 1), *wide], key=repr)


def test_numeric_profile_of_large_ids(spark):
    df = spark.range(5).selectExpr("4000000000000000000 + id as id")
    assert profile.numeric_profile(df).first()["mean"] is not None


def test_quantiles_outside_their_bracket_are_found_again(spark, monkeypatch):
    from millrace.operators import quantiles
    real = quantiles._ranked

    def blind(present, probs, slack, accuracy):
        out = real(present, probs, slack, accuracy)
        return out if slack >= 0.01 else out.withColumns({"lo": F.lit(None).cast("double"), "hi": F.lit(None).cast("double")})

    monkeypatch.setattr(quantiles, "_ranked", blind)
    df = quantiles.to_long(spark.range(1001).selectExpr("id as x"), ["x"])
    got = {r["prob"]: r["quantile"] for r in quantiles.exact_quantiles(df, [0.05, 0.5]).collect()}
    assert got == {0.05: 50.0, 0.5: 500.0}


def test_type_suspects(spark):
    df = spark.createDataFrame([("1", "true", "2026-01-01", "x"), ("2.5", "False", "2026-01-02 10:00:00", "9")],
                               "n string, b string, t string, other string")
    assert dict(rows(profile.type_suspects(df, df.columns), "column", "suspect")) == {
        "n": "number", "b": "boolean", "t": "timestamp", "other": None}


def test_header_share_and_top(spark):
    df = spark.createDataFrame([("o", 2, "d2"), ("o", 1, "d1"), ("q", 1, "d9")], "k string, line int, depot string")
    assert rows(order_header(df, "k", ["line"], ["depot"])) == [("o", "d1", 2), ("q", "d9", 1)]
    totals = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0)], "m string, v int")
    assert rows(with_share(totals, "v")) == [("a", 3, 0.75), ("b", 1, 0.25), ("c", 0, 0.0)]
    assert rows(with_share(totals.filter("v = 0"), "v")) == [("c", 0, 0.0)]
    assert [r["m"] for r in top_k(totals, "v", ["m"], 2).collect()] == ["a", "b"]


def test_membership_changes(spark):
    a, b = spark.createDataFrame([("x",), ("y",), ("y",)], "k string"), spark.createDataFrame([("y",), ("z",)], "k string")
    assert rows(membership_changes(a, b, "k")) == [("x", "REMOVED"), ("z", "NEW")]
