"""Deterministic defects, to prove that a gate or a test turns red.

Rows are picked by a condition over their own columns, so the same input
gives the same defects on any cluster layout.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.checks import TableTest, run_tests


def _change(df: DataFrame, column: str, where: Column, to: Column) -> DataFrame:
    return df.withColumn(column, F.when(where, to).otherwise(F.col(column)))


def orphan_keys(df: DataFrame, column: str, where: Column, bad_keys: Sequence, pick: Column) -> DataFrame:
    """Replace the key by one of `bad_keys`, chosen by `pick` modulo their number."""
    choice = F.element_at(F.array(*[F.lit(k) for k in bad_keys]), (pick % len(bad_keys) + 1).cast("int"))
    return _change(df, column, where, choice)


def repeat_rows(df: DataFrame, where: Column, change: dict[str, Column] | None = None) -> DataFrame:
    """Append a copy of the rows selected, optionally changed. The input is read once."""
    copy = F.explode(F.when(where, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    changed = {c: F.when(F.col("_is_copy"), to).otherwise(F.col(c)) for c, to in (change or {}).items()}
    both = df.withColumn("_is_copy", copy)
    return (both.withColumns(changed) if changed else both).drop("_is_copy")


def non_positive(df: DataFrame, column: str, where: Column, values: Sequence[int], pick: Column) -> DataFrame:
    return orphan_keys(df, column, where, values, pick)


def blank(df: DataFrame, column: str, where: Column) -> DataFrame:
    return _change(df, column, where, F.lit(None).cast(df.schema[column].dataType))


def scale_price(df: DataFrame, column: str, where: Column, factor: Column) -> DataFrame:
    """Multiply and round to two decimals; `factor` is a decimal, so ties are exact."""
    return _change(df, column, where, (F.col(column) * factor).cast(df.schema[column].dataType))


def invert_times(df: DataFrame, start: str, end: str, where: Column, hours: int = 2) -> DataFrame:
    return _change(df, end, where, F.col(start) - F.make_dt_interval(F.lit(0), F.lit(hours)))


def ghost_rows(df: DataFrame, where: Column, keys: Sequence[str], offset: int) -> DataFrame:
    """Append copies whose keys are moved out of range."""
    return repeat_rows(df, where, {k: F.col(k) + offset for k in keys})


def respell(df: DataFrame, column: str, where: Column, spellings: Sequence[str], pick: Column) -> DataFrame:
    return orphan_keys(df, column, where, spellings, pick)


def flip_sign(df: DataFrame, column: str, where: Column) -> DataFrame:
    return _change(df, column, where, -F.col(column))


def negative_margin(df: DataFrame, price: str, cost: str, where: Column, factor: str = "0.91") -> DataFrame:
    """Set the price below the cost."""
    return _change(df, price, where, (F.col(cost) * F.expr(factor)).cast(df.schema[price].dataType))


def break_star(star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """A star in which each of its table tests has something to find: repeated, missing and unknown keys, and bad measures."""
    lines, trips, depots, products = (star[n] for n in ("fact_orders", "fact_deliveries", "dim_depot", "dim_product"))
    order, trip, depot, product = (F.col(c) for c in ("order_id", "delivery_id", "depot_id", "product_id"))
    lines = repeat_rows(lines, order % 53 == 1)
    lines = blank(lines, "order_line_id", order % 59 == 2)
    lines = orphan_keys(lines, "depot_id", order % 47 == 3, [-1], F.lit(0))
    lines = orphan_keys(lines, "product_id", order % 61 == 4, [-1], F.lit(0))
    lines = flip_sign(lines, "line_value", order % 67 == 5)
    trips = orphan_keys(trips, "depot_id", trip % 61 == 4, [-1], F.lit(0))
    trips = flip_sign(trips, "distance_km", trip % 67 == 5)
    trips = blank(repeat_rows(trips, trip % 53 == 1), "delivery_id", trip % 59 == 2)
    depots = blank(repeat_rows(depots, depot % 17 == 1), "depot_id", depot % 19 == 2)
    products = blank(repeat_rows(products, product % 23 == 1), "product_id", product % 29 == 2)
    return {"fact_orders": lines, "fact_deliveries": trips, "dim_depot": depots, "dim_product": products}


def sabotage(tests: Sequence[TableTest], sound: Mapping[str, DataFrame], hurt: Mapping[str, DataFrame]) -> DataFrame:
    """Test results on the damaged and on the restored tables, with a `phase` column."""
    phases = {"sabotaged": hurt, "restored": sound}
    parts = [run_tests(tests, tables).select(F.lit(phase).alias("phase"), "*") for phase, tables in phases.items()]
    return parts[0].unionByName(parts[1])
