"""What a table promises: rules as data, and the catalogue that lists them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAIL, WARN, CLEANSE, DOCUMENT = "FAIL", "WARN", "CLEANSE", "DOCUMENT"


@dataclass(frozen=True)
class Rule:
    """`halt` stops the load on the first violation, whatever the threshold."""

    id: str
    column: str
    reason: str
    action: str = FAIL
    halt: bool = False

    @property
    def flag(self) -> str:
        return f"_dq_{self.id.lower()}"


@dataclass(frozen=True)
class RowRule(Rule):
    """`bad` selects the wrong rows; where it is unknown the row passes."""

    bad: Column = field(default=None, compare=False)


@dataclass(frozen=True)
class UniqueRule(Rule):
    """Every row of a repeated key is wrong. `column` may list several, comma separated."""

    @property
    def keys(self) -> list[str]:
        return [c.strip() for c in self.column.split(",")]


@dataclass(frozen=True)
class ForeignKeyRule(Rule):
    """Rows whose `column` is not among `parent_column` of `parent`."""

    parent: DataFrame = field(default=None, compare=False)
    parent_column: str = ""
    null_is_orphan: bool = True


@dataclass(frozen=True)
class Lookup:
    """Master columns that the rules of a table refer to ({master column: helper name})."""

    column: str
    master: DataFrame = field(compare=False)
    master_column: str
    values: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class RegisterEntry:
    """A line of the rule register; DOCUMENT and CLEANSE entries check nothing in the gate."""

    id: str
    table: str
    column: str
    defect: str
    action: str
    rationale: str


def register_frame(spark: SparkSession, entries: Sequence[RegisterEntry]) -> DataFrame:
    return spark.createDataFrame(
        [(e.id, e.table, e.column, e.defect, e.action, e.rationale) for e in entries],
        "rule string, table string, column string, defect string, action string, rationale string",
    )


def check(df: DataFrame, bad: Column, label: str) -> DataFrame:
    """Count violations without removing any: (check, violations, status)."""
    n = F.count_if(bad)
    return df.agg(n.alias("violations")).select(
        F.lit(label).alias("check"), "violations",
        F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def examples(df: DataFrame, bad: Column, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first `n` violating rows by `order`."""
    return df.filter(bad).orderBy(*order).limit(n)


def conformance_gap(df: DataFrame, column: str) -> DataFrame:
    """(column, non_conforming, raw_values, conformed_values) against trim + upper.

    NULL is neither conforming nor a value. Distinct spellings are counted
    from one frequency table, so the rows are shuffled as counts.
    """
    spelled = df.groupBy(F.col(column).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    tidy = F.upper(F.trim(F.col("s")))
    return spelled.agg(
        F.coalesce(F.sum(F.when(F.col("s") != tidy, F.col("n"))), F.lit(0)).alias("non_conforming"),
        F.count("s").alias("raw_values"),
        F.count_distinct(tidy).alias("conformed_values"),
    ).select(F.lit(column).alias("column"), "non_conforming", "raw_values", "conformed_values")
