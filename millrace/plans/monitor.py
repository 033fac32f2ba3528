"""Drift and health over a run log (`plans/runs.py`).

A window orders one row per run and table, never the loaded rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.ratios import safe_ratio


def quarantine_rate(log: DataFrame) -> DataFrame:
    """Add `rate_pct` per run."""
    per_run = log.groupBy("table", *[c for c in ("run_id", "run_date") if c in log.columns]).agg(
        F.sum("rows_in").alias("rows_in"), F.sum("violations").alias("violations")
    )
    return per_run.withColumn("rate_pct", safe_ratio(F.col("violations") * 100.0, F.col("rows_in")))


def drift_hard(rates: DataFrame, limit_pct: float = 5.0) -> DataFrame:
    """Runs above the fixed limit."""
    return rates.filter(F.col("rate_pct") > limit_pct)


def drift_soft(rates: DataFrame, days: int = 7, points: float = 2.0) -> DataFrame:
    """Runs above the mean of the previous `days` days by more than `points`.

    The mean is that of the daily rates present, and a run without any
    earlier one in reach cannot drift.
    """
    back = Window.partitionBy("table").orderBy(F.unix_date("run_date")).rangeBetween(-days, -1)
    with_mean = rates.withColumn("mean_pct", F.avg("rate_pct").over(back))
    return with_mean.filter(F.col("rate_pct") > F.col("mean_pct") + points)


def orphan_increase(rows: DataFrame, orphan_rows: DataFrame, key: str, day: Column, rule: str) -> DataFrame:
    """Per run of `rows`: orphans, those of the run before, the difference, and keys never seen before.

    (rule, run_date, orphans, new_bad_keys, previous, increase); a run without orphans counts 0.
    """
    runs = rows.select(day.alias("run_date")).distinct()
    per_key = orphan_rows.groupBy(day.alias("run_date"), key).agg(F.count(F.lit(1)).alias("n"))
    first_seen = per_key.groupBy(key).agg(F.min("run_date").alias("run_date")).groupBy("run_date").agg(
        F.count(F.lit(1)).alias("new_bad_keys")
    )
    counts = per_key.groupBy("run_date").agg(F.sum("n").alias("orphans"))
    # One row per run from here on.
    found = counts.join(first_seen, "run_date", "left").withColumnRenamed("run_date", "_day")
    daily = runs.join(found, F.col("run_date").eqNullSafe(F.col("_day")), "left").select(
        F.lit(rule).alias("rule"), "run_date", F.coalesce("orphans", F.lit(0)).cast("bigint").alias("orphans"), "new_bad_keys")
    return _with_previous(daily, "run_date")


def orphan_increase_by_run(log: DataFrame, held: DataFrame, key: str, rule: str) -> DataFrame:
    """The same per run of a log: orphans are what `rule` rejected, and new keys come from the quarantine of all runs.

    `held` carries `_run`, `_dq_rule` and the key. (rule, run_id, run_date, orphans, new_bad_keys, previous, increase)
    """
    per_run = log.filter(F.col("rule") == rule).select(
        "rule", "run_id", "run_date", F.col("rows_rejected").alias("orphans"))
    place = F.struct("run_date", "run_id")
    seen = held.filter(F.col("_dq_rule") == rule).select(F.col("_run").alias("run_id"), key).distinct().join(per_run, "run_id")
    first = seen.groupBy(key).agg(F.min(place).alias("at")).groupBy(F.col("at.run_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("new_bad_keys"))
    return _with_previous(per_run.join(first, "run_id", "left"), "run_date", "run_id")


def _with_previous(daily: DataFrame, *by: str) -> DataFrame:
    """One row per run from here on."""
    order = Window.partitionBy("rule").orderBy(*by)
    previous = F.coalesce(F.lag("orphans").over(order), F.lit(0))
    return daily.select(
        "rule", *reversed(by), "orphans", F.coalesce("new_bad_keys", F.lit(0)).cast("bigint").alias("new_bad_keys"),
        previous.alias("previous"), (F.col("orphans") - previous).alias("increase"),
    )


def breach_alert(deliveries: DataFrame, by: Column, *limits_pct: float) -> DataFrame:
    """(member, deliveries, breaches, breach_pct, limit_pct, alert) for every limit, 6 % if none is given."""
    counts = deliveries.groupBy(by.alias("member")).agg(
        F.count(F.lit(1)).alias("deliveries"), F.count_if(F.col("temperature_breach_flag")).alias("breaches")
    )
    rate = safe_ratio(F.col("breaches") * 100.0, F.col("deliveries"))
    limits = F.array(*[F.lit(float(x)) for x in limits_pct or (6.0,)])
    return counts.withColumns({"breach_pct": rate, "limit_pct": F.explode(limits)}).withColumn(
        "alert", F.col("breach_pct") > F.col("limit_pct"))


def refresh_latency(runs: DataFrame, limit_minutes: int = 30) -> DataFrame:
    """Add `minutes` between started_at and finished_at, and WARN above the limit."""
    minutes = F.timestamp_diff("MINUTE", F.col("started_at"), F.col("finished_at"))
    return runs.withColumn("minutes", minutes).withColumn(
        "status", F.when(F.col("minutes") > limit_minutes, "WARN").otherwise("PASS")
    )
