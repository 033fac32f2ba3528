"""Rollups that several models share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import settle


def group_having(df: DataFrame, keys: Sequence[str], more_than: int = 1) -> DataFrame:
    """Groups with more than so many rows: keys and n."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > more_than)


def order_header(lines: DataFrame, key: str, order_by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """First row of each group by `order_by`, as one row of `values` per key.

    A minimum over (order, values) combines on the map side, so no group is
    sorted or gathered, and ties fall the same way every time.
    """
    first = F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)], *values))
    return lines.groupBy(key).agg(first.alias("_f"), F.count(F.lit(1)).alias("n_lines")).select(
        key, *[F.col(f"_f.{v}").alias(v) for v in values], "n_lines"
    )


def with_share(totals: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Add each group's part of the overall total as a double (0 if the total is 0).

    The groups are written once; the total and the parts read them back.
    """
    totals = settle(totals, "totals")
    whole = totals.agg(F.sum(value).cast("double").alias("_whole"))
    share = F.when(F.col("_whole").isNull() | (F.col("_whole") == 0), F.lit(0.0)).otherwise(
        F.col(value).cast("double") / F.col("_whole"))
    return totals.join(F.broadcast(whole)).withColumn(name, share).drop("_whole")  # one row


def top_k(df: DataFrame, by: str, tie: Sequence[str], k: int) -> DataFrame:
    """The k largest by `by`, ties by `tie`."""
    return df.orderBy(F.desc(by), *tie).limit(k)
