"""A run log: one row per load, table and rule, committed with the load's tables.

(run_id, run_date, table, rule, action, rows_in, violations, rows_rejected,
identical_removed, started_at, finished_at, status). `rows_in` less
`identical_removed` less the rejected rows of all rules is what silver holds. Violations of a unique rule are
repeated keys. The log is a table of the store (`sources/snapshots.py`): a part per run, there exactly once, read
whole or from a version on. A load that broke off has rows of status FAILED, and others once it is repeated.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.rules import FAIL, UniqueRule
from millrace.operators.tagging import FIRST, Tagged
from millrace.sources.snapshots import FAILED

RUN_LOG, QUARANTINE = "run_log", "quarantine"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass(frozen=True)
class Run:
    """Names one load. `clock` is asked when it starts and when its tables are written."""

    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    run_date: dt.date = field(default_factory=dt.date.today)
    clock: Callable[[], dt.datetime] = _now


def log_entries(run: Run, tables: Mapping[str, DataFrame], tagged: Mapping[str, Tagged], results: DataFrame,
                started: dt.datetime, finished: dt.datetime, status: str) -> DataFrame:
    """The log's rows of a load that was judged."""
    def counted(df: DataFrame, name: str, column: str) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        n = F.count(F.lit(1))
        return df.agg(*[(n if c == column else F.max(zero)).alias(c) for c in ("rows_in", "judged")]).withColumn(
            "table", F.lit(name))

    both = [counted(df, name, column) for name in tagged if tagged[name].rules
            for df, column in ((tables[name], "rows_in"), (tagged[name].frame, "judged"))]
    sizes = reduce(DataFrame.unionByName, both).groupBy("table").agg(
        F.sum("rows_in").alias("rows_in"), F.sum(F.coalesce("judged", F.lit(0))).alias("judged"))
    return results.join(F.broadcast(sizes), "table").select(  # a row per table
        F.lit(run.run_id).alias("run_id"), F.lit(run.run_date).alias("run_date"), "table", "rule", "action",
        F.coalesce("rows_in", F.lit(0)).cast("bigint").alias("rows_in"), "violations", "rows_rejected",
        F.coalesce(F.col("rows_in") - F.col("judged"), F.lit(0)).cast("bigint").alias("identical_removed"),
        F.lit(started).alias("started_at"), F.lit(finished).alias("finished_at"), F.lit(status).alias("status"))


def backfill(raw: DataFrame, tagged: Tagged, day: Column) -> DataFrame:
    """The log's rows of a table's days, from one judgement of all of them; when they were loaded is not known.

    A day without rejections has its rows too, and rows without a day are a load of their own.
    """
    read = raw.groupBy(day.alias("run_date")).agg(F.count(F.lit(1)).alias("rows_in"))
    fails = [(i, rule) for i, rule in tagged.positions if rule.action == FAIL]
    judged = tagged.frame.groupBy(day.alias("_day")).agg(
        F.count(F.lit(1)).alias("judged"), *[F.count_if(F.col(FIRST) == i).alias(f"r{i}") for i, _ in fails],
        *[_keys_or_rows(i, rule).alias(f"v{i}") for i, rule in fails])
    both = read.join(judged, F.col("run_date").eqNullSafe(F.col("_day")), "left")
    lines = [F.struct(F.lit(rule.id).alias("rule"), F.lit(rule.action).alias("action"),
                      F.coalesce(f"v{i}", F.lit(0)).cast("bigint").alias("found"),
                      F.coalesce(f"r{i}", F.lit(0)).cast("bigint").alias("n")) for i, rule in fails]
    unknown = F.lit(None).cast("timestamp")
    return both.withColumn("x", F.explode(F.array(*lines))).select(
        F.coalesce(F.col("run_date").cast("string"), F.lit("no day")).alias("run_id"), "run_date",
        F.lit(tagged.table).alias("table"), "x.rule", "x.action", "rows_in", F.col("x.found").alias("violations"),
        F.col("x.n").alias("rows_rejected"), (F.col("rows_in") - F.col("judged")).alias("identical_removed"),
        unknown.alias("started_at"), unknown.alias("finished_at"), F.lit("PASS").alias("status"))


def _keys_or_rows(i: int, rule) -> Column:
    hit = F.col(FIRST) == i
    return F.count_distinct(*[F.when(hit, F.col(k)) for k in rule.keys]) if isinstance(rule, UniqueRule) else F.count_if(hit)


def ended(log: DataFrame) -> DataFrame:
    """Without loads that broke off: each run once."""
    return log.filter(F.col("status") != FAILED)


def loads(log: DataFrame) -> DataFrame:
    """(run_id, run_date, table, rows_in, violations) per run and table; violations are the rejected rows."""
    return ended(log).groupBy("run_id", "run_date", "table").agg(
        F.max("rows_in").alias("rows_in"), F.sum("rows_rejected").alias("violations"))


def durations(log: DataFrame) -> DataFrame:
    """(run_id, started_at, finished_at), one row per run."""
    return ended(log).groupBy("run_id").agg(
        F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"))
