"""Texts that explain a measure, and the check that they add no figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.figures import derivations, figures_in, ungrounded


def explain_context(values: DataFrame, baselines: DataFrame, period: str) -> DataFrame:
    """(measure, value, baseline, context): the only figures an explanation may use.

    `values` and `baselines` are (measure, value) frames.
    """
    base = baselines.select("measure", F.col("value").alias("baseline"))
    line = F.concat(
        F.col("measure"), F.lit(" = "), _plain(F.col("value")), F.lit(f" for {period}; baseline "),
        F.coalesce(_plain(F.col("baseline")), F.lit("not given")),
    )
    return values.join(base, "measure", "left").withColumn("context", line)


def _plain(number: Column) -> Column:
    """Two decimals, no exponent."""
    return number.cast("decimal(24,2)").cast("string")


def grounding_check(texts: DataFrame, text: str, provided: Column, percent_form: bool = False) -> DataFrame:
    """Add n_figures, ungrounded (the figures nobody provided) and PASS or FAIL per text."""
    found = texts.withColumn("_figures", figures_in(F.col(text)))
    checked = found.withColumns({
        "n_figures": F.size("_figures"), "ungrounded": ungrounded(F.col("_figures"), provided, percent_form)
    }).drop("_figures")
    return checked.withColumn("status", F.when(F.size("ungrounded") > 0, "FAIL").otherwise("PASS"))


def explain_change(context: DataFrame, stated: Column) -> DataFrame:
    """(measure, text): a sentence on each measure, its baseline and the difference; `stated` is what it gives as the value."""
    money = [c.cast("decimal(24,2)") for c in (F.col("value"), F.col("baseline"))]
    gap = F.abs(money[0] - money[1]).cast("string")
    return context.select("measure", "value", "baseline", F.concat(
        F.col("measure"), F.lit(" was "), _plain(stated), F.lit(" against "), _plain(F.col("baseline")),
        F.lit(", a difference of "), gap, F.lit(".")).alias("text"))


def derivation_check(texts: DataFrame, text: str, provided: Column) -> DataFrame:
    """Add `figures`, (figure, how) of every figure of a text, and FAIL where one follows from nothing that was provided."""
    judged = texts.withColumn("figures", derivations(figures_in(F.col(text)), provided))
    unknown = F.exists("figures", lambda x: x["how"] == "unknown")
    return judged.withColumn("status", F.when(unknown, "FAIL").otherwise("PASS"))
