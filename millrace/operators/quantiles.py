"""Exact quantiles whose state stays bounded.

Spark's exact `percentile` keeps every distinct value of a column in one
buffer. Here a mergeable sketch first brackets each wanted rank, and only the
values inside the bracket, a fixed fraction of the rows, are counted and ranked,
by ranges: no task holds a whole bracket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.positions import running_total
from millrace.sources.tables import settle

ACCURACY = 20_000
# Bracket half-width in units of the sketch's error bound.
MARGIN = 4


def to_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) with one row per cell of the numeric columns, as double."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "value")


def exact_quantiles(long: DataFrame, probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """(column, prob, quantile), linear interpolation between the two nearest ranks.

    Runs jobs. A rank that its bracket misses is looked for again in a wider one, in the end among all values.
    """
    present = long.filter(F.col("value").isNotNull())
    slack, found = MARGIN / accuracy, None
    while True:
        here = settle(_ranked(present, probs, slack, accuracy), "quantiles")
        hit = F.col("lo").isNotNull() & F.col("hi").isNotNull()
        found = here.filter(hit) if found is None else found.unionByName(
            here.filter(hit).join(found.select("column", "prob"), ["column", "prob"], "left_anti"))
        if slack >= 1 or here.filter(~hit).isEmpty():
            break
        slack *= 8
    fraction = F.col("rank") - F.floor("rank")
    return found.select("column", "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * fraction).alias("quantile"))


def _ranked(present: DataFrame, probs: Sequence[float], slack: float, accuracy: int) -> DataFrame:
    """(column, prob, rank, lo, hi): the values at the whole ranks around each wanted one, NULL outside the bracket."""
    edges = [e for p in probs for e in (max(p - slack, 0.0), min(p + slack, 1.0))]
    stats = present.groupBy("column").agg(
        F.count("value").alias("n"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.percentile_approx("value", [float(e) for e in edges], accuracy).alias("edges"),
    )
    brackets = [
        F.struct(
            F.lit(float(p)).alias("prob"),
            (F.col("min") if p - slack <= 0 else F.col("edges")[2 * i]).alias("low"),
            (F.col("max") if p + slack >= 1 else F.col("edges")[2 * i + 1]).alias("high"),
            ((F.col("n") - 1) * F.lit(float(p))).alias("rank"),
        )
        for i, p in enumerate(probs)
    ]
    wanted = settle(stats.select("column", F.explode(F.array(*brackets)).alias("b")).select("column", "b.*"), "brackets")

    # `wanted` has one row per column and probability, whatever the input size.
    near = present.join(F.broadcast(wanted), "column").filter(F.col("value") <= F.col("high"))
    counted = near.groupBy(
        "column", "prob", "rank", F.when(F.col("value") >= F.col("low"), F.col("value")).alias("v")
    ).agg(F.count(F.lit(1)).alias("n"))
    # NULL `v` stands for everything below the bracket and sorts first. Ranks come from
    # ranges of the whole order, less where their (column, prob) starts.
    spans = running_total(counted, "n", "column", "prob", "v")
    starts = F.col("upto") - F.col("n")
    spans = settle(spans.withColumn("from", starts), "rank-spans")
    first = spans.groupBy("column", "prob").agg(F.min("from").alias("_first"))  # a row per column and probability
    spans = spans.join(F.broadcast(first), ["column", "prob"])

    def value_at(rank):
        at = rank + F.col("_first")
        return F.max(F.when((F.col("from") <= at) & (at < F.col("upto")), F.col("v")))

    return spans.groupBy("column", "prob", "rank").agg(
        value_at(F.floor("rank")).alias("lo"), value_at(F.ceil("rank")).alias("hi"))
