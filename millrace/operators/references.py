"""Joins between a child table and its parents.

Spark broadcasts a parent when its size is below the threshold and otherwise
shuffles both sides, where adaptive execution splits a hot key's partition. Parents
may therefore be of any size; only keys that were written and measured (`known_keys`) carry a hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.ratios import percent
from millrace.operators.joins import sent_if_small, skew_join
from millrace.sources.tables import settle


def _parent_keys(parent: DataFrame, parent_col: str) -> DataFrame:
    """Distinct, so that a parent of many rows is one row before any join."""
    return parent.select(F.col(parent_col).alias("_pk")).filter("_pk is not null").distinct()


def known_keys(parent: DataFrame, parent_col: str) -> DataFrame:
    """The parent's distinct keys, written; broadcast if they fit into a task, so that children stay where they are (runs jobs)."""
    keys = settle(parent.select(parent_col).filter(F.col(parent_col).isNotNull()).distinct(), "parent-keys")
    return sent_if_small(keys)


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: of conflicting versions the smallest by the other columns in their order."""
    others = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min(F.struct(*others)).alias("_first"))
    return first.select(*[F.col(c) if c == key else F.col(f"_first.{c}").alias(c) for c in df.columns])


def orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
            null_is_orphan: bool = True) -> DataFrame:
    """Child rows without a parent. A NULL key is one, unless `null_is_orphan` is off."""
    rows = child if null_is_orphan else child.filter(F.col(child_col).isNotNull())
    return skew_join(rows, _parent_keys(parent, parent_col), [(child_col, "_pk")], "left_anti")


def with_parent(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows that have a parent."""
    return skew_join(child, _parent_keys(parent, parent_col), [(child_col, "_pk")], "left_semi")


def mark_parent(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str, name: str) -> DataFrame:
    """Add boolean `name`: the parent exists. Never multiplies child rows."""
    keys = _parent_keys(parent, parent_col).withColumn(name, F.lit(True))
    joined = skew_join(child, keys, [(child_col, "_pk")], "left").drop("_pk")
    return joined.withColumn(name, F.col(name).isNotNull())


def lookup(child: DataFrame, child_col: str, master: DataFrame, master_col: str,
           values: dict[str, str]) -> DataFrame:
    """Left join that adds master columns under new names ({master column: new name}).

    `master_col` must be unique in the master, as it is after its own unique rule.
    """
    wanted = master.filter(F.col(master_col).isNotNull()).select(
        F.col(master_col).alias("_mk"), *[F.col(c).alias(new) for c, new in values.items()]
    )
    return skew_join(child, wanted, [(child_col, "_mk")], "left").drop("_mk")


def fk_report(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
              label: str, show: int = 10) -> DataFrame:
    """One row: orphans, their share of non-NULL keys, distinct bad keys and the first of them.

    Orphans are counted per key before anything else, so a bad key that fills
    a third of the table is one row from then on. The keys are joined to their
    parents once and written; totals and examples read that.
    """
    per_key = (
        child.filter(F.col(child_col).isNotNull())
        .groupBy(F.col(child_col).alias("_ck")).agg(F.count(F.lit(1)).alias("_n"))
    )
    parents = _parent_keys(parent, parent_col).withColumn("_has", F.lit(True))
    keys = settle(per_key.join(parents, F.col("_ck") == F.col("_pk"), "left").select("_ck", "_n", "_has"), "fk-keys")
    bad = F.col("_has").isNull()
    first = (
        keys.filter(bad).select("_ck").orderBy("_ck").limit(show)
        .agg(F.sort_array(F.collect_list("_ck")).alias("_v"))
        .select(F.array_join(F.transform("_v", lambda x: x.cast("string")), ","))
    )
    totals = keys.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"),
                      F.coalesce(F.sum(F.when(bad, F.col("_n"))), F.lit(0)).alias("orphans"),
                      F.count_if(bad).alias("distinct_bad_keys"))
    return totals.select(
        F.lit(label).alias("check"),
        "orphans",
        percent(F.col("orphans"), F.col("checked")).alias("orphan_pct"),
        "distinct_bad_keys",
        first.scalar().alias("first_bad_keys"),
        F.when(F.col("orphans") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def membership_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(member, change) with change NEW or REMOVED between two loads of a dimension."""
    old, new = before.select(key).distinct(), after.select(key).distinct()
    added = new.join(old, key, "left_anti").withColumn("change", F.lit("NEW"))
    gone = old.join(new, key, "left_anti").withColumn("change", F.lit("REMOVED"))
    return added.unionByName(gone).withColumnRenamed(key, "member")


def precedes_first(events: DataFrame, key: str, at: str, parents: DataFrame, parent_at: str) -> DataFrame:
    """Inner join of events to the earliest parent time of their key, added as `first_at`.

    Adds boolean `too_early`: the event lies before that time.
    """
    keyed = parents.filter(F.col(key).isNotNull())
    first = keyed.groupBy(F.col(key).alias("_pk")).agg(F.min(parent_at).alias("first_at"))
    early = F.col(at) < F.col("first_at")
    joined = skew_join(events, first, [(key, "_pk")], "inner").drop("_pk")
    return joined.withColumn("too_early", F.coalesce(early, F.lit(False)))
