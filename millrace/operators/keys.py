"""Uniqueness: identical rows, repeated keys, and how the two differ.

Nothing here puts a key's rows into one task: rows and keys are counted with
map-side combining, and a hot key's rows are joined in splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import sent_if_small, skew_join
from millrace.sources.raw import LINEAGE
from millrace.sources.tables import settle

CONFLICT = "_key_conflict"


def repeated_keys(df: DataFrame, keys: Sequence[str], among: Column | None = None) -> DataFrame:
    """Non-NULL key values that occur more than once (among the rows given)."""
    rows = df if among is None else df.filter(among)
    keyed = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return rows.groupBy(*keys).agg(F.count_if(keyed).alias("_n")).filter("_n > 1").select(*keys)


def drop_identical(df: DataFrame, ignore: Sequence[str] = LINEAGE) -> DataFrame:
    """One row per group of rows equal in all columns but `ignore`.

    Of the ignored columns the earliest load survives, so two batches holding
    the same row give the same result in any order.
    """
    extra = [c for c in ignore if c in df.columns]
    business = [c for c in df.columns if c not in extra]
    if not extra:
        return df.dropDuplicates()
    earliest = df.groupBy(*business).agg(F.min(F.struct(*extra)).alias("_first"))
    return earliest.select(*[F.col(f"_first.{c}").alias(c) if c in extra else F.col(c) for c in df.columns])


def mark_conflicts(df: DataFrame, keys: Sequence[str], among: Column | None = None,
                   name: str = CONFLICT) -> DataFrame:
    """Add boolean `name`: the key repeats among the rows for which `among` holds.

    Always false outside `among` and for NULL keys.
    """
    hits = repeated_keys(df, keys, among).toDF(*[f"_r{i}" for i in range(len(keys))]).withColumn(name, F.lit(True))
    pairs = [(k, f"_r{i}") for i, k in enumerate(keys)]
    marked = skew_join(df, hits, pairs, "left").drop(*[right for _, right in pairs])
    repeats = F.col(name).isNotNull()
    return marked.withColumn(name, repeats if among is None else repeats & among)


def drop_identical_and_mark(df: DataFrame, keys: Sequence[str], ignore: Sequence[str] = LINEAGE,
                            name: str = CONFLICT) -> DataFrame:
    """`drop_identical` and then `mark_conflicts`, without moving the rows of keys that occur once.

    Identical rows share their key, so only the rows of repeated keys, or of a NULL
    key, can be copies or conflicts. Those keys are counted first, on the key columns
    alone, written and measured: a list that fits into a task is broadcast, and Spark
    splits hot partitions when it does not. Runs jobs.
    """
    hits = sent_if_small(settle(repeated_keys(df, keys), "repeated-keys")).toDF(*[f"_r{i}" for i in range(len(keys))])
    pairs = [(k, f"_r{i}") for i, k in enumerate(keys)]
    keyed = reduce(and_, [F.col(k).isNotNull() for k in keys])
    suspects = skew_join(df.filter(keyed), hits, pairs, "left_semi").unionByName(df.filter(~keyed))
    alone = skew_join(df.filter(keyed), hits, pairs, "left_anti").withColumn(name, F.lit(False))
    return alone.unionByName(mark_conflicts(drop_identical(suspects, ignore), keys, None, name))


def reject_repeated(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of unique keys, all rows of repeated keys); NULL keys count as unique."""
    repeated = repeated_keys(df, keys).toDF(*[f"_r{i}" for i in range(len(keys))])
    pairs = [(k, f"_r{i}") for i, k in enumerate(keys)]
    return skew_join(df, repeated, pairs, "left_anti"), skew_join(df, repeated, pairs, "left_semi")


def _versions_per_key(df: DataFrame, key: str, ignore: Sequence[str]) -> DataFrame:
    """(key, n, versions): rows and different rows per key. NULL is a key here.

    Keys are counted alone; only the rows of repeated keys are then compared,
    spread by all their columns. Runs a job.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hits = settle(counts.filter("n > 1").select(F.col(key).alias("_r0")), "repeated-keys")
    business = [c for c in df.columns if c not in ignore]
    rows = skew_join(df, hits, [(key, "_r0")], "left_semi").groupBy(*business).agg(F.count(F.lit(1)).alias("n"))
    several = rows.groupBy(key).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("versions"))
    return counts.filter("n = 1").withColumn("versions", F.lit(1).cast("long")).unionByName(several)


def key_integrity(df: DataFrame, key: str, table: str) -> DataFrame:
    """One row: rows, distinct keys, surplus rows, surplus identical rows, OK or DUP."""
    totals = _versions_per_key(df, key, ()).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(key).alias("distinct_keys"),
        F.coalesce(F.sum("versions"), F.lit(0)).alias("different"),
    )
    surplus = F.col("n_rows") - F.col("distinct_keys")
    return totals.select(
        F.lit(table).alias("table"),
        F.lit(key).alias("key"),
        "n_rows",
        "distinct_keys",
        surplus.alias("surplus_rows"),
        (F.col("n_rows") - F.col("different")).alias("identical_rows"),
        F.when(surplus == 0, "OK").otherwise("DUP").alias("status"),
    )


def duplicate_kind(df: DataFrame, key: str, ignore: Sequence[str] = LINEAGE) -> DataFrame:
    """Repeated keys by kind: IDENTICAL (a double load) or CONFLICT (different rows).

    Columns: kind, n_keys, n_rows.
    """
    repeated = _versions_per_key(df, key, ignore).filter(F.col(key).isNotNull() & (F.col("n") > 1))
    kind = F.when(F.col("versions") == 1, "IDENTICAL").otherwise("CONFLICT")
    return repeated.groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows")
    )
