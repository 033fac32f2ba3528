"""All rules of a table in one pass.

Checking rules one after another on the survivors needs a job per rule. Here
every row gets the position of the first FAIL rule it breaks, `_dq_first`;
the rest follows from it:

* rule i rejected exactly the rows with `_dq_first = i`;
* survivors are the rows without it;
* a WARN rule at position i saw the rows that no earlier rule had rejected.

A unique rule counts keys among rows that earlier rules left alone, so the
result equals sequential gating in the given order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleanse import is_true
from millrace.operators import keys as key_ops
from millrace.operators.references import lookup, mark_parent
from millrace.operators.rules import FAIL, WARN, ForeignKeyRule, Lookup, Rule, RowRule, UniqueRule
from millrace.sources.raw import LINEAGE

FIRST = "_dq_first"


@dataclass(frozen=True)
class Tagged:
    """A table with its verdicts; `frame` holds the rows, FIRST and the WARN flags."""

    table: str
    frame: DataFrame
    rules: tuple[Rule, ...]
    helpers: tuple[str, ...] = ()

    @property
    def positions(self) -> list[tuple[int, Rule]]:
        return list(enumerate(self.rules))

    @property
    def flags(self) -> list[str]:
        return [r.flag for r in self.rules if r.action == WARN]

    @property
    def data_columns(self) -> list[str]:
        own = {FIRST, *self.flags, *self.helpers}
        return [c for c in self.frame.columns if c not in own]

    def replace(self, frame: DataFrame) -> "Tagged":
        return Tagged(self.table, frame, self.rules, self.helpers)


def _before(verdicts: list[tuple[int, Rule, str]]) -> Column | None:
    """No FAIL rule among `verdicts` is broken; None if there is none."""
    intact = [~F.col(name) for _, rule, name in verdicts if rule.action == FAIL]
    return reduce(and_, intact) if intact else None


def tag(
    df: DataFrame,
    table: str,
    rules: Sequence[Rule],
    lookups: Sequence[Lookup] = (),
    drop_identical: bool = False,
    ignore: Sequence[str] = LINEAGE,
    to_count: bool = False,
) -> Tagged:
    """Judge every row of `df` by `rules`, in their order.

    With `drop_identical`, copies of a row equal in all columns but `ignore`
    are removed first and belong to neither survivors nor quarantine. With `to_count` as well, the key of a leading
    unique rule stays only in the rows that break it, where it is counted, so that later joins need not move it.
    """
    verdicts: list[tuple[int, Rule, str]] = []
    pending = list(lookups)
    marked = drop_identical and bool(rules) and isinstance(rules[0], UniqueRule)
    if marked:
        df = key_ops.drop_identical_and_mark(df, rules[0].keys, ignore, "_bad0")
        if to_count:
            df = df.withColumns({k: F.when(F.col("_bad0"), F.col(k)) for k in rules[0].keys})
    elif drop_identical:
        df = key_ops.drop_identical(df, ignore)
    for i, rule in enumerate(rules):
        name = f"_bad{i}"
        if marked and i == 0:
            verdicts.append((i, rule, name))
            continue
        # Masters join after leading unique rules, which read the table twice.
        while pending and not isinstance(rule, UniqueRule):
            step = pending.pop(0)
            df = lookup(df, step.column, step.master, step.master_column, step.values)
        if isinstance(rule, UniqueRule):
            df = key_ops.mark_conflicts(df, rule.keys, _before(verdicts), name)
        elif isinstance(rule, ForeignKeyRule):
            df = mark_parent(df, rule.column, rule.parent, rule.parent_column, name)
            orphan = ~F.col(name)
            if not rule.null_is_orphan:
                orphan = orphan & F.col(rule.column).isNotNull()
            df = df.withColumn(name, orphan)
        elif isinstance(rule, RowRule):
            df = df.withColumn(name, is_true(rule.bad))
        else:
            raise TypeError(f"{rule.id}: not a checkable rule")
        verdicts.append((i, rule, name))

    failing = [(i, name) for i, rule, name in verdicts if rule.action == FAIL]
    first = F.coalesce(*[F.when(F.col(name), F.lit(i)) for i, name in failing], F.lit(None).cast("int"))
    tagged = df.withColumn(FIRST, first)
    seen = F.col(FIRST).isNull()
    tagged = tagged.withColumns(
        {rule.flag: F.col(name) & (seen | (F.col(FIRST) > i))
         for i, rule, name in verdicts if rule.action == WARN} or {FIRST: F.col(FIRST)}
    ).drop(*[name for _, _, name in verdicts])
    helpers = tuple(new for step in lookups for new in step.values.values())
    return Tagged(table, tagged, tuple(rules), helpers)


def survivors(tagged: Tagged) -> DataFrame:
    """Rows that broke no FAIL rule, with their WARN flags (always present, never NULL)."""
    return tagged.frame.filter(F.col(FIRST).isNull()).drop(FIRST, *tagged.helpers)


def _pick(tagged: Tagged, attribute: str) -> Column:
    """Attribute of the rule at `_dq_first`, as an expression."""
    values = F.array(*[F.lit(getattr(r, attribute)) for r in tagged.rules])
    return F.element_at(values, F.col(FIRST) + 1)


def rejected(tagged: Tagged) -> DataFrame:
    """Rows that broke a FAIL rule, with `_dq_table`, `_dq_rule` and `_dq_reason`.

    Values that a lookup brought in stay, as `_dq_expected<name>`: they are the
    evidence of a disagreement with the master.
    """
    rows = tagged.frame.filter(F.col(FIRST).isNotNull()).withColumns(
        {"_dq_table": F.lit(tagged.table), "_dq_rule": _pick(tagged, "id"),
         "_dq_reason": _pick(tagged, "reason")}
    )
    for name in tagged.helpers:
        rows = rows.withColumnRenamed(name, f"_dq_expected{name}")
    return rows.drop(FIRST, *tagged.flags)
