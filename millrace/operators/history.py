"""Validity intervals of members over loads of a master, and joins as of a time.

A history has a row per member and state: the member's columns, `valid_from`, when the load that brought the state
came, and `valid_to`, when a later load changed or dropped it (NULL while it holds). A member's intervals
do not overlap. A load is the whole master, one row per key; rows with a NULL key name no member.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FROM, TO = "valid_from", "valid_to"
BROADCAST_ROWS = 100_000  # cut intervals that may be sent to every task


def _at(moment: dt.datetime) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def extend(history: DataFrame | None, load: DataFrame, keys: Sequence[str], moment: dt.datetime) -> DataFrame:
    """The history after one more load, which comes after all others: one join of the open states with the load."""
    values = [c for c in load.columns if c not in keys]
    named = load.dropna(subset=list(keys))
    if history is None:
        return named.withColumns({FROM: _at(moment), TO: F.lit(None).cast("timestamp_ntz")})

    def state(column: str, begin: Column, end: Column) -> Column:
        return F.struct(*[F.coalesce(f"_o_{k}", f"_n_{k}").alias(k) for k in keys],
                        *[F.col(f"{column}.{v}").alias(v) for v in values], begin.alias(FROM), end.alias(TO))

    held = history.filter(F.col(TO).isNull()).select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], F.struct(*values).alias("_old"), F.col(FROM).alias("_since"))
    new = named.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.struct(*values).alias("_new"))
    both = held.join(new, [F.col(f"_o_{k}") == F.col(f"_n_{k}") for k in keys], "full")
    same = F.col("_old").eqNullSafe(F.col("_new"))
    never = F.lit(None).cast("timestamp_ntz")
    states = F.array_compact(F.array(
        F.when(F.col("_old").isNotNull(), state("_old", F.col("_since"), F.when(~same, _at(moment)).otherwise(never))),
        F.when(F.col("_new").isNotNull() & ~same, state("_new", _at(moment), never))))
    moved = both.select(F.explode(states).alias("s")).select("s.*")
    return history.filter(F.col(TO).isNotNull()).unionByName(moved)


def changes(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, at, change): NEW, CHANGED or REMOVED, one row per member and load that touched it; a sum, no window."""
    edges = F.explode(F.array_compact(F.array(
        F.struct(F.col(FROM).alias("at"), F.lit(True).alias("begins")),
        F.when(F.col(TO).isNotNull(), F.struct(F.col(TO).alias("at"), F.lit(False).alias("begins"))))))
    met = history.select(*keys, edges.alias("e")).groupBy(*keys, F.col("e.at").alias("at")).agg(
        F.bool_or("e.begins").alias("_begins"), F.bool_or(~F.col("e.begins")).alias("_ends"))
    change = F.when(~F.col("_begins"), "REMOVED").when(F.col("_ends"), "CHANGED").otherwise("NEW")
    return met.select(*keys, "at", change.alias("change"))


def members_at(history: DataFrame, keys: Sequence[str], moment: dt.datetime) -> DataFrame:
    """The last state known at a time of every member, withdrawn ones too, with `is_active`."""
    known = history.filter(F.col(FROM) <= _at(moment))
    rest = [c for c in history.columns if c not in keys]
    last = known.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(FROM)).alias("s"))
    active = F.col(f"s.{TO}").isNull() | (F.col(f"s.{TO}") > _at(moment))
    return last.select(*keys, *[F.col(f"s.{c}").alias(c) for c in rest if c not in (FROM, TO)], active.alias("is_active"))


def as_of(rows: DataFrame, key: str, time: str, history: DataFrame, history_key: str, values: dict[str, str],
          days: int = 366) -> DataFrame:
    """Add `values` ({column: new name}) of the state that was valid at each row's time; NULL where none was (runs two jobs).

    Intervals are cut at ranges of `days`, and rows meet them by key and range: a key that holds any share of the
    rows is spread over its ranges, no row's order matters, and no window gathers a key. As intervals of a
    key do not overlap, a row meets one at most and stays one row. The cut intervals are many times the history's
    rows, which Spark's estimate does not tell; they are counted first, and many of them are never broadcast.
    """
    def range_of(moment: Column) -> Column:
        return F.floor(F.unix_date(moment.cast("date")) / days)

    moment = F.col(time).cast("timestamp_ntz")
    first, last = rows.agg(F.min(range_of(moment)), F.max(range_of(moment))).first()
    if first is None:
        return rows.withColumns({new: F.lit(None).cast(history.schema[c].dataType) for c, new in values.items()})
    begin = F.greatest(range_of(F.col(FROM)), F.lit(first))
    end = F.least(F.coalesce(range_of(F.col(TO)), F.lit(last)), F.lit(last))
    n_cut = history.filter(begin <= end).agg(F.coalesce(F.sum(end - begin + 1), F.lit(0))).first()[0]
    cut = history.filter(begin <= end).select(
        F.col(history_key).alias("_key"), F.col(FROM).alias("_from"), F.col(TO).alias("_to"),
        *[F.col(c).alias(new) for c, new in values.items()], F.explode(F.sequence(begin, end)).alias("_range"))
    met = ((F.col(key) == F.col("_key")) & (range_of(moment) == F.col("_range")) & (moment >= F.col("_from"))
           & (F.col("_to").isNull() | (moment < F.col("_to"))))
    return rows.join(cut.hint("merge") if n_cut > BROADCAST_ROWS else cut, met, "left").drop("_key", "_range", "_from", "_to")
