"""Ratios that survive a zero denominator, exact percentages and sample skew."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column, otherwise: float = 0.0) -> Column:
    """numerator / denominator as double; `otherwise` for a zero or NULL denominator."""
    n, d = numerator.cast("double"), denominator.cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(otherwise)).otherwise(n / d)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole of two counts, rounded half up at two decimals.

    Integer arithmetic, so the digits do not depend on a binary fraction.
    Exact while `part` stays below 4e14 rows.
    """
    p, w = part.cast("bigint"), whole.cast("bigint")
    hundredths = F.call_function("div", p * 20000 + w, w * 2)
    return (
        F.when(w.isNull() | (w == 0), F.lit(0).cast("decimal(18,2)"))
        .otherwise((hundredths.cast("decimal(18,0)") * F.expr("0.01")).cast("decimal(18,2)"))
    )


def sample_skew(c: Column) -> Column:
    """Bias-adjusted sample skewness (an aggregate); NULL below three values."""
    n = F.count(c).cast("double")
    return F.when(n >= 3, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))
