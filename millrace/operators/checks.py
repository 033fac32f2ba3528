"""Declarative tests over published tables. A test passes when it finds nothing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.keys import repeated_keys
from millrace.operators.references import orphans


@dataclass(frozen=True)
class TableTest:
    """kind: unique, not_null, relationships or rows (rows selected by `bad` are failures)."""

    kind: str
    table: str
    column: str
    to_table: str = ""
    to_column: str = ""
    bad: Column | None = field(default=None, compare=False)


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Repeated non-NULL values."""
    return repeated_keys(df, [column])


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def relationship_failures(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows with a non-NULL value that the parent lacks."""
    return orphans(df, column, parent, parent_column, null_is_orphan=False)


def _key_failures(test: TableTest, tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables[test.table]
    if test.kind == "unique":
        return unique_failures(df, test.column)
    if test.kind == "relationships":
        return relationship_failures(df, test.column, tables[test.to_table], test.to_column)
    raise ValueError(f"unknown test kind {test.kind!r}")


def _labels(test: TableTest) -> list[Column]:
    return [F.lit(test.kind).alias("test"), F.lit(test.table).alias("table"), F.lit(test.column).alias("column")]


def _row_tests(df: DataFrame, tests: Sequence[TableTest]) -> DataFrame:
    """Tests that judge single rows share one scan of their table."""
    bad = [F.col(t.column).isNull() if t.kind == "not_null" else t.bad for t in tests]
    counts = df.agg(*[F.count_if(b).alias(f"f{i}") for i, b in enumerate(bad)])
    lines = [F.struct(*_labels(t), F.col(f"f{i}").alias("failures")) for i, t in enumerate(tests)]
    return counts.select(F.explode(F.array(*lines)).alias("x")).select("x.*")


def run_tests(tests: Sequence[TableTest], tables: Mapping[str, DataFrame]) -> DataFrame:
    """(test, table, column, failures, status), one row per test."""
    by_row: dict[str, list[TableTest]] = {}
    frames = []
    for t in tests:
        if t.kind in ("not_null", "rows"):
            by_row.setdefault(t.table, []).append(t)
        else:
            found = _key_failures(t, tables).agg(F.count(F.lit(1)).alias("failures"))
            frames.append(found.select(*_labels(t), "failures"))
    frames += [_row_tests(tables[table], group) for table, group in by_row.items()]
    every = reduce(DataFrame.unionByName, frames)
    return every.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


def summary(results: DataFrame) -> DataFrame:
    """Tests and failures per status."""
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("tests"), F.sum("failures").alias("failures")
    )


class TestsFailed(Exception):
    """At least one table test failed, so promotion is blocked."""


def block_on_failure(results: DataFrame) -> None:
    """Raise if any test failed (an action; one row per failed test reaches the driver)."""
    failed = results.filter("status = 'FAIL'").collect()
    if failed:
        raise TestsFailed(", ".join(f"{r['test']} {r['table']}.{r['column']}: {r['failures']}" for r in failed))
