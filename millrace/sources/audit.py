"""Row counts of what was landed, against what the source held."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class LandingMismatch(Exception):
    """A landed table does not hold as many rows as its source."""


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows), one row per table."""
    return _union(
        [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
         for name, df in tables.items()]
    )


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows, n_cols)."""
    return _union(
        [df.agg(F.count(F.lit(1)).alias("n_rows"))
         .select(F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))
         for name, df in tables.items()]
    )


def count_gate(source: dict[str, DataFrame], landed: dict[str, DataFrame]) -> DataFrame:
    """(table, source_rows, landed_rows, status); status HALT where they differ."""
    both = row_audit(source).withColumnRenamed("n_rows", "source_rows").join(
        row_audit(landed).withColumnRenamed("n_rows", "landed_rows"), "table", "full"
    )
    same = F.col("source_rows").eqNullSafe(F.col("landed_rows"))
    return both.withColumn("status", F.when(same, "PASS").otherwise("HALT"))


def enforce_counts(gate: DataFrame) -> None:
    """Raise if any table differs (an action; one row per table reaches the driver)."""
    wrong = gate.filter("status = 'HALT'").collect()
    if wrong:
        detail = ", ".join(f"{r['table']}: {r['source_rows']} read, {r['landed_rows']} landed" for r in wrong)
        raise LandingMismatch(detail)
