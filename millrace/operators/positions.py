"""Positions and running totals of one global order, without a window over everything."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.tables import settle


def running_total(df: DataFrame, weight: str, *order: str, name: str = "upto") -> DataFrame:
    """Add `name`: the sum of `weight` up to and with each row, in the order of the given columns (NULL first).

    Rows are dealt into ranges; each range adds up its own rows and the sums of the
    ranges before it. Only those sums, one per range, meet in one task.
    """
    dealt = settle(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = dealt.groupBy("_range").agg(F.sum(weight).alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = F.sum(weight).over(
        Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return dealt.join(starts, "_range").withColumn(name, within + F.col("_start")).drop("_range", "_start")


def number_rows(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """Add `name`: 1, 2, ... in the order of the given columns (NULL first)."""
    return running_total(df.withColumn("_one", F.lit(1).cast("long")), "_one", *order, name=name).drop("_one")
