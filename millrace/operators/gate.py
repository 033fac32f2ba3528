"""Rule results, the threshold gate, and the quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.ratios import percent
from millrace.operators.rules import FAIL, WARN, UniqueRule
from millrace.operators.tagging import FIRST, Tagged, rejected


class ContractViolation(Exception):
    """Too many rows broke a contract, or a halting rule was broken."""


def _table_results(tagged: Tagged) -> DataFrame:
    """One aggregate over the tagged rows, turned into a row per rule."""
    counts, rows = [], []
    for i, rule in tagged.positions:
        if rule.action == WARN:
            n = F.count_if(F.col(rule.flag))
            counts.append(n.alias(f"v{i}"))
            continue
        hit = F.col(FIRST) == i
        rows.append(F.count_if(hit).alias(f"r{i}"))
        if isinstance(rule, UniqueRule):
            counts.append(F.count_distinct(*[F.when(hit, F.col(k)) for k in rule.keys]).alias(f"v{i}"))
        else:
            counts.append(F.count_if(hit).alias(f"v{i}"))
    totals = tagged.frame.agg(*counts, *rows)
    lines = [
        F.struct(
            F.lit(rule.id).alias("rule"),
            F.lit(tagged.table).alias("table"),
            F.lit(rule.reason).alias("description"),
            F.lit(rule.action).alias("action"),
            F.col(f"v{i}").alias("violations"),
            (F.col(f"r{i}") if rule.action == FAIL else F.lit(0).cast("bigint")).alias("rows_rejected"),
            F.lit(rule.halt).alias("halts"),
        )
        for i, rule in tagged.positions
    ]
    flat = totals.select(F.explode(F.array(*lines)).alias("x")).select("x.*")
    return flat.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise(F.col("action")))


def rule_results(tables: Sequence[Tagged]) -> DataFrame:
    """(rule, table, description, action, violations, rows_rejected, halts, status).

    A unique rule's violations are repeated keys; `rows_rejected` counts the
    rows it moved to quarantine. For other FAIL rules the two agree.
    """
    return reduce(DataFrame.unionByName, [_table_results(t) for t in tables])


def gate_totals(results: DataFrame, total: DataFrame, *max_pct: float) -> DataFrame:
    """FAIL violations, rejected rows, rows in, both rates and a verdict per threshold (5 % if none).

    `total` is a one-row, one-column frame with the number of rows read.
    """
    fails = F.when(F.col("action") == FAIL, F.col("violations"))
    summed = results.agg(
        F.coalesce(F.sum(fails), F.lit(0)).alias("fail_violations"),
        F.coalesce(F.sum("rows_rejected"), F.lit(0)).alias("rows_quarantined"),
        F.coalesce(F.bool_or(F.col("halts") & (F.col("violations") > 0)), F.lit(False)).alias("halted"),
    ).withColumns({
        "rows_in": F.coalesce(total.scalar(), F.lit(0)),
        "threshold_pct": F.explode(F.array(*[F.lit(float(p)) for p in max_pct or (5.0,)])),
    })
    over = F.col("fail_violations") * 100.0 > F.col("rows_in") * F.col("threshold_pct")
    return summed.select(
        "fail_violations",
        "rows_quarantined",
        "rows_in",
        percent(F.col("fail_violations"), F.col("rows_in")).alias("violation_pct"),
        percent(F.col("rows_quarantined"), F.col("rows_in")).alias("quarantine_pct"),
        "threshold_pct",
        F.when(F.col("halted") | over, "HALT").otherwise("PASS").alias("status"),
    )


def raise_if_halted(totals: DataFrame) -> None:
    """Raise `ContractViolation` for totals of a shut gate (an action on one row)."""
    row = totals.first()
    if row["status"] == "HALT":
        raise ContractViolation(
            f"{row['fail_violations']} violations in {row['rows_in']} rows "
            f"({row['violation_pct']} %), threshold {row['threshold_pct']} %"
        )


def enforce(results: DataFrame, total: DataFrame, max_pct: float = 5.0) -> DataFrame:
    """Raise `ContractViolation` if the gate is shut (an action on one row), else return its totals."""
    totals = gate_totals(results, total, max_pct)
    raise_if_halted(totals)
    return totals


def rows_in(frames: Sequence[DataFrame]) -> DataFrame:
    """Total row count of several frames, as a one-row frame."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")) for df in frames]
    return reduce(DataFrame.union, counts).agg(F.sum("n").alias("n"))


def quarantine(tables: Sequence[Tagged]) -> DataFrame:
    """Rejected rows of all tables, columns by name, missing ones NULL."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [rejected(t) for t in tables]
    )


def triage(quarantined: DataFrame) -> DataFrame:
    """Which rule rejected how many rows."""
    return quarantined.groupBy("_dq_table", "_dq_rule", "_dq_reason").agg(F.count(F.lit(1)).alias("n_rows"))
