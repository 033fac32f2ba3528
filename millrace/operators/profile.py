"""What a table looks like: types, gaps, distributions, spellings.

Wide statistics go through a long form (column, value) with a grouped count,
so frequent values shrink before the shuffle and every later step works on
distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.ratios import percent, sample_skew
from millrace.operators.positions import number_rows
from millrace.operators.quantiles import exact_quantiles, to_long
from millrace.sources.tables import settle

BINS = 45


def _text_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "value")


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) over several columns in one pass; NULL is a value of its own."""
    return _text_long(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def schema_audit(df: DataFrame, table: str, approximate: bool = False) -> DataFrame:
    """One row per column: type, non-NULL and NULL counts, NULL %, distinct values, a sample.

    The sample is the smallest value as text, so repeated runs agree. Counts and
    samples are one ungrouped aggregate, which shuffles a row per task. So is
    all of it with `approximate`, where HyperLogLog sketches replace the exact
    distinct counts, the only step that shuffles values.
    """
    stats = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        stats += [F.count(F.col(c)).alias(f"c{i}"), F.min(F.col(c).cast("string")).alias(f"s{i}")]
        if approximate:
            stats.append(F.approx_count_distinct(F.col(c)).alias(f"u{i}"))
    lines = [
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"c{i}").alias("non_null"), F.col(f"s{i}").alias("sample"),
            *([F.col(f"u{i}").alias("n_unique")] if approximate else []),
        )
        for i, f in enumerate(df.schema)
    ]
    per_column = df.agg(*stats).select("n", F.explode(F.array(*lines)).alias("x")).select("n", "x.*")
    if not approximate:
        distinct = frequencies(df, df.columns).groupBy("column").agg(F.count("value").alias("n_unique"))
        per_column = per_column.join(distinct, "column", "left").na.fill(0, ["n_unique"])
    nulls = F.col("n") - F.col("non_null")
    return per_column.select(
        F.lit(table).alias("table"), "column", "dtype", "non_null", nulls.alias("nulls"),
        percent(nulls, F.col("n")).alias("null_pct"), "n_unique", "sample",
    )


def missingness(df: DataFrame, table: str) -> DataFrame:
    """Columns with NULLs, worst first: (table, column, nulls, pct). One row per column at most."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}")
                                        for i, c in enumerate(df.columns)]
    )
    lines = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("nulls")) for i, c in enumerate(df.columns)]
    return (
        counts.select("n", F.explode(F.array(*lines)).alias("x")).filter("x.nulls > 0")
        .select(F.lit(table).alias("table"), "x.column", "x.nulls", percent(F.col("x.nulls"), F.col("n")).alias("pct"))
        .orderBy(F.desc("pct"), "column")
    )


def missingness_by(df: DataFrame, column: str, slice_by: str) -> DataFrame:
    """NULL count and rate of one column within each value of another."""
    return df.groupBy(slice_by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(column).isNull()).alias("nulls")
    ).withColumn("null_pct", percent(F.col("nulls"), F.col("n_rows")))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """min, p05, median, p95, max, mean, skew, negatives and zeros per numeric column.

    Quantiles are exact. Mean and skew are rounded to two decimals.
    """
    long = to_long(df, columns or numeric_columns(df))
    base = long.groupBy("column").agg(
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.avg("value").cast("decimal(38,2)").alias("mean"),
        sample_skew(F.col("value")).cast("decimal(38,2)").alias("skew"),
        F.count_if(F.col("value") < 0).alias("n_negative"),
        F.count_if(F.col("value") == 0).alias("n_zero"),
    )
    names = {0.05: "p05", 0.5: "median", 0.95: "p95"}
    marks = exact_quantiles(long, list(names)).groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for p, name in names.items()]
    )
    order = ["column", "min", "p05", "median", "p95", "max", "mean", "skew", "n_negative", "n_zero"]
    return base.join(marks, "column", "left").select(*order)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """Equal-width bins: (column, bin, low, n, median). Empty bins have no row."""
    long = to_long(df, columns).filter(F.col("value").isNotNull())
    bounds = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    middle = exact_quantiles(long, [0.5]).select("column", F.col("quantile").alias("median"))
    # One row per column, so this side is bounded by the schema.
    frame = bounds.join(middle, "column").withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    place = F.when(F.col("width") == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / F.when(F.col("width") != 0, F.col("width"))),
                F.lit(bins - 1))
    ).cast("int")
    return (
        long.join(F.broadcast(frame), "column")
        .groupBy("column", place.alias("bin"), "lo", "width", "median").agg(F.count(F.lit(1)).alias("n"))
        .select("column", "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("low"), "n", "median")
    )


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every value of the text columns, most frequent first: (column, n_distinct, position, value, n).

    All columns are ordered in one distributed sort and a column's positions count from
    where it starts there; a caller who wants the first k filters on `position`.
    """
    freq = frequencies(df, columns).withColumns({"_less": -F.col("n"), "_absent": F.col("value").isNull()})
    placed = settle(number_rows(freq, "column", "_less", "_absent", "value", name="_at"), "value-positions")
    # One row per column of the schema.
    heads = placed.groupBy("column").agg(F.count("value").alias("n_distinct"), F.min("_at").alias("_first"))
    return placed.join(F.broadcast(heads), "column").select(
        "column", "n_distinct", (F.col("_at") - F.col("_first") + 1).cast("int").alias("position"), "value", "n")


def type_suspects(df: DataFrame, columns: Sequence[str], threshold_pct: float = 95.0) -> DataFrame:
    """Text columns whose non-NULL values parse as another type.

    (column, non_null, as_number, as_boolean, as_timestamp, suspect); suspect is
    the first type that at least `threshold_pct` of the values fit.
    """
    text = F.col("value")
    # A bare number would parse as a year, so a time must also look like one.
    dated = F.when(text.rlike("^[0-9]{4}-[0-9]{1,2}"), text)
    tests = {"as_number": text.try_cast("double"), "as_boolean": text.try_cast("boolean"),
             "as_timestamp": dated.try_cast("timestamp")}
    freq = frequencies(df, columns).filter(F.col("value").isNotNull())
    fits = freq.groupBy("column").agg(
        F.sum("n").alias("non_null"),
        *[F.coalesce(F.sum(F.when(parsed.isNotNull(), F.col("n"))), F.lit(0)).alias(name)
          for name, parsed in tests.items()],
    )
    suspect = reduce(
        lambda chain, name: chain.when(F.col(name) * 100.0 >= F.col("non_null") * threshold_pct, name[3:]),
        list(tests)[1:],
        F.when(F.col("as_number") * 100.0 >= F.col("non_null") * threshold_pct, "number"),
    )
    return fits.withColumn("suspect", suspect)


@dataclass(frozen=True)
class Finding:
    """A line of the defect register; `count` is a one-row, one-column frame."""

    table: str
    column: str
    defect: str
    action: str
    count: DataFrame


def defect_register(findings: Sequence[Finding]) -> DataFrame:
    """(table, column, defect, n_rows, action), one row per finding."""
    parts = [
        f.count.toDF("n_rows").select(
            F.lit(f.table).alias("table"), F.lit(f.column).alias("column"), F.lit(f.defect).alias("defect"),
            "n_rows", F.lit(f.action).alias("action"))
        for f in findings
    ]
    return reduce(DataFrame.unionByName, parts)
