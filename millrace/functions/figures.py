"""Numbers written in a text, and which of them nobody provided."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: an unsigned figure with optional thousands groups and decimals.
FIGURE = r"[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?"


def figures_in(text: Column) -> Column:
    """Distinct figures of a text as plain digits (thousands commas removed)."""
    found = F.regexp_extract_all(text, F.lit(FIGURE), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit(""))))


def _value(x: Column) -> Column:
    return x.try_cast("double")


def ungrounded(figures: Column, provided: Column, percent_form: bool = False) -> Column:
    """Those `figures` (array of digits) whose value is not among `provided` (array of numbers).

    With `percent_form` a ratio may also be written as a percentage, so 0.88
    grounds 88.
    """
    allowed = F.array_compact(F.transform(provided, lambda x: x.cast("double")))
    allowed = F.coalesce(allowed, F.array().cast("array<double>"))
    if percent_form:
        allowed = F.concat(allowed, F.transform(allowed, lambda x: F.round(x * 100, 6)))
    return F.filter(figures, lambda x: ~F.array_contains(allowed, _value(x)))


def derivations(figures: Column, provided: Column) -> Column:
    """How each of `figures` follows from `provided`: an array of (figure, how).

    `how` is given, sum, difference, percent (100 a/b) or ratio (a/b) of two provided numbers, in this order, or unknown. A figure is
    met to the decimals it is written with. The search is over pairs, so its work is the square of what is provided.
    """
    numbers = F.coalesce(F.array_compact(F.transform(provided, lambda x: x.cast("double"))), F.array().cast("array<double>"))

    def meets(values: Column, figure: Column) -> Column:
        decimals = F.length(F.regexp_extract(figure, r"\.([0-9]+)$", 1))
        reach = F.lit(0.5) / F.pow(F.lit(10.0), decimals) + 1e-9
        return F.exists(values, lambda x: F.abs(x - _value(figure)) <= reach)

    def pairs(f) -> Column:
        """What `f` makes of every two of the numbers, in both orders; none is paired with itself."""
        return F.array_compact(F.flatten(F.transform(
            numbers, lambda a, i: F.transform(numbers, lambda b, j: F.when(i != j, f(a, b))))))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b != 0, a / b)

    ways = {"given": numbers, "sum": pairs(lambda a, b: a + b), "difference": pairs(lambda a, b: F.abs(a - b)),
            "percent": pairs(lambda a, b: 100.0 * ratio(a, b)), "ratio": pairs(ratio)}

    def how(figure: Column) -> Column:
        named = [F.when(meets(values, figure), F.lit(name)) for name, values in ways.items()]
        return F.struct(figure.alias("figure"), F.coalesce(*named, F.lit("unknown")).alias("how"))

    return F.transform(figures, how)
