"""The measures of every member of every dimension, kept as sums that can be merged, and the answers read from them.

A row holds what one table has for one member in one bucket of its keys:

    fact, dimension, member     the table, the dimension (NULL: all rows) and its member (NULL: rows without one)
    bucket, keys, n_keys        2^15 consecutive keys, a bitmap of those that occur, and their number
    n_rows, line_value, delivered, breaches

All dimensions of a table come from one pass over it, combined before the shuffle; buckets spread a hot member over
many tasks. Distinct keys are counted exactly: each stands in one bucket, so their counts add up. Sums add and bitmaps
unite, so the cube of a new load is merged with the one before (`merge`) and no earlier fact is read again. A bitmap is
4 KB for each member and bucket with a row, so keys should be dense integers; others are refused.

`answers` finds any number of questions in one scan of the cube, without its bitmaps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from millrace.functions.ratios import safe_ratio
from millrace.operators.references import one_per_key
from millrace.plans.measures import (
    DELIVERED,
    DIMENSIONS,
    INTERSECT,
    MEASURES,
    OVERRIDE,
    RELATIONSHIPS,
    UnknownRequest,
    dimension_table,
    known_measure,
)

PLACE = ("fact", "dimension", "member", "bucket")
SUMS = ("n_rows", "line_value", "delivered", "breaches")
# What each table counts distinct, if anything; a NULL key is not counted.
KEYS = {"fact_orders": lambda: F.col("order_id"), "dim_product": lambda: F.when(F.col("is_active"), F.col("product_id"))}
TABLES = ("fact_orders", "fact_deliveries", "dim_product", "dim_depot")


def reachable(fact: str) -> list[str]:
    """Dimensions that a filter on them carries to the table."""
    return [d for d, table in DIMENSIONS.items() if table == fact or (fact, table) in RELATIONSHIPS]


def _with_members(gold: Mapping[str, DataFrame], fact: str) -> DataFrame:
    """The table's rows with the members of all their dimensions; no row is lost or doubled."""
    rows = gold[fact]
    for (child, table), key in RELATIONSHIPS.items():
        if child == fact:
            own = [d for d in DIMENSIONS if DIMENSIONS[d] == table]
            rows = rows.join(one_per_key(gold[table].select(key, *own), key), key, "left")
    return rows


def _cube_of(gold: Mapping[str, DataFrame], fact: str) -> DataFrame:
    rows = _with_members(gold, fact)
    members = [F.struct(F.lit(None).cast("string").alias("dimension"), F.lit(None).cast("string").alias("member"))]
    members += [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("member")) for d in reachable(fact)]
    key = KEYS[fact]() if fact in KEYS else F.lit(None).cast("long")
    kind = rows.select(key.alias("k")).schema["k"].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"{fact}: bitmaps need integer keys, not {kind.simpleString()}; number them first")
    has = set(rows.columns)
    spread = rows.select(
        F.explode(F.array(*members)).alias("x"), key.cast("long").alias("_key"),
        (F.col("line_value") if "line_value" in has else F.lit(0).cast("decimal(12,2)")).alias("_value"),
        (F.col("status") == DELIVERED if "status" in has else F.lit(False)).alias("_delivered"),
        (F.col("temperature_breach_flag") if "temperature_breach_flag" in has else F.lit(False)).alias("_breach"),
    ).select("x.*", "_key", "_value", "_delivered", "_breach", F.bitmap_bucket_number("_key").alias("bucket"))
    sums = [F.count(F.lit(1)).alias("n_rows"), F.sum("_value").cast("decimal(38,2)").alias("line_value"),
            F.count_if("_delivered").alias("delivered"), F.count_if("_breach").alias("breaches")]
    if fact in KEYS:
        sums.append(F.bitmap_construct_agg(F.bitmap_bit_position("_key")).alias("keys"))
    # Bitmaps are aggregated by sorting; one number in front settles nearly every comparison of two places.
    place = F.xxhash64("dimension", "member", "bucket").alias("_place")
    grouped = spread.groupBy(place, "dimension", "member", "bucket").agg(*sums).drop("_place")
    if fact not in KEYS:
        grouped = grouped.withColumn("keys", F.lit(None).cast("binary"))
    return _counted(grouped.withColumn("fact", F.lit(fact)))


def _counted(cube: DataFrame) -> DataFrame:
    return cube.select(*PLACE, *SUMS, F.coalesce(F.bitmap_count("keys"), F.lit(0).cast("long")).alias("n_keys"), "keys")


def build_cube(gold: Mapping[str, DataFrame]) -> DataFrame:
    """The cube of a star, lazily; write it before it is asked more than once.

    A fact without a parent falls under the NULL member. Of repeated keys of a dimension one version counts. An
    empty table has no rows here, and its answers are 0.
    """
    return reduce(DataFrame.unionByName, [_cube_of(gold, fact) for fact in TABLES])


def merge(cubes: Sequence[DataFrame]) -> DataFrame:
    """One cube of the loads of several, as long as no row of a table is in two of them.

    Dimensions that every load brings whole are put into one of the cubes alone.
    """
    together = reduce(DataFrame.unionByName, cubes).groupBy(*PLACE)
    return _counted(together.agg(*[F.sum(c).cast("decimal(38,2)" if c == "line_value" else "long").alias(c) for c in SUMS],
                                 F.bitmap_or_agg("keys").alias("_united"), F.count("keys").alias("_n"))
                    .withColumn("keys", F.when(F.col("_n") > 0, F.col("_united"))))


@dataclass(frozen=True)
class Question:
    """A measure under an optional filter; `mode` as in `measures.query_metric`."""

    measure: str
    dimension: str | None = None
    member: str | None = None
    mode: str = OVERRIDE

    def places(self) -> list[tuple[str, str | None, str | None]]:
        """(what is read, dimension, member): the rows that the filter leaves, and where the numerator of the rate is."""
        fact = known_measure(self.measure).fact
        if self.mode not in (OVERRIDE, INTERSECT):
            raise UnknownRequest(f"unknown filter mode {self.mode!r}")
        if self.dimension is not None:
            dimension_table(self.dimension)
        reached = self.dimension in reachable(fact)
        where = (self.dimension, self.member) if reached else (None, None)
        replaced = self.dimension == "status" and self.mode == OVERRIDE
        return [("rows", *where), ("delivered", *((None, None) if replaced else where))]


def _value(measure: Column, n_rows: Column, line_value: Column, delivered: Column, breaches: Column, n_keys: Column) -> Column:
    by_measure = {
        "Total Revenue": F.coalesce(line_value, F.lit(0)),
        "Total Orders": F.coalesce(n_keys, F.lit(0)),
        "Order Lines": F.coalesce(n_rows, F.lit(0)),
        "Avg Line Value": safe_ratio(line_value, n_rows),
        "Active Products": F.coalesce(n_keys, F.lit(0)),
        "Total Deliveries": F.coalesce(n_rows, F.lit(0)),
        "Delivery Success Rate": safe_ratio(F.coalesce(delivered, F.lit(0)), n_rows),
        "Cold Chain Breaches": F.coalesce(breaches, F.lit(0)),
    }
    chosen = F.lit(None).cast("double")
    for name, value in by_measure.items():
        chosen = F.when(measure == name, value.cast("double")).otherwise(chosen)
    return chosen


def answers(cube: DataFrame, questions: Sequence[Question], model: str = "gold_star") -> DataFrame:
    """(place, measure, dimension, member, mode, value, grounded_from), one row for each question, in one scan."""
    asked = [(i, q.measure, q.dimension, q.member, q.mode, known_measure(q.measure).fact, *place)
             for i, q in enumerate(questions) for place in q.places()]
    wanted = cube.sparkSession.createDataFrame(
        asked, "place int, measure string, dimension string, member string, mode string, "
               "_fact string, _what string, _dimension string, _member string")
    found = wanted.join(
        cube.select(*PLACE[:3], *SUMS, "n_keys").select(*[F.col(c).alias(f"c_{c}") for c in (*PLACE[:3], *SUMS, "n_keys")]),
        (F.col("c_fact") == F.col("_fact")) & F.col("c_dimension").eqNullSafe(F.col("_dimension"))
        & F.when(F.col("_dimension").isNull(), True).otherwise(F.col("c_member") == F.col("_member")), "left")

    def total(name: str, what: str) -> Column:
        return F.sum(F.when(F.col("_what") == what, F.col(f"c_{name}"))).alias(f"s_{name}")

    sums = found.groupBy("place", "measure", "dimension", "member", "mode").agg(
        total("n_rows", "rows"), total("line_value", "rows"), total("delivered", "delivered"), total("breaches", "rows"),
        total("n_keys", "rows"))
    value = _value(F.col("measure"), *[F.col(f"s_{c}") for c in (*SUMS, "n_keys")])
    return sums.select("place", "measure", "dimension", "member", "mode", value.alias("value"),
                       F.lit(model).alias("grounded_from"))


def answers_by(cube: DataFrame, asked: Sequence[tuple[str, str]]) -> DataFrame:
    """(measure, dimension, member, value): each measure for every member of its dimension, in one scan.

    As `measures.measure_by`: a dimension that does not reach the measure's table gives the unfiltered value to each
    of its members.
    """
    wanted = []
    for measure, dimension in asked:
        fact, table = known_measure(measure).fact, dimension_table(dimension)
        reached = dimension in reachable(fact)
        # Members come from the measure's own table, or from the one that holds the dimension.
        wanted.append((measure, dimension, fact if reached else table, fact, dimension if reached else None, reached))
    ask = cube.sparkSession.createDataFrame(
        wanted, "measure string, dimension string, _source string, _fact string, _at string, _reached boolean")
    sums = cube.groupBy(*PLACE[:3]).agg(*[F.sum(c).alias(c) for c in (*SUMS, "n_keys")])
    members = sums.select(F.col("fact").alias("_source"), "dimension", "member")
    values = sums.select(F.col("fact").alias("_fact"), F.col("dimension").alias("_at"), F.col("member").alias("_of"),
                         *SUMS, "n_keys").alias("v")
    # Unfiltered answers meet a row per table; the rest meets its own member.
    listed = ask.join(members, ["_source", "dimension"]).alias("m")
    same = F.col("m._at").eqNullSafe(F.col("v._at")) & F.when(F.col("m._reached"), F.col("m.member").eqNullSafe(F.col("v._of"))
                                                              ).otherwise(True)
    met = listed.join(values, (F.col("m._fact") == F.col("v._fact")) & same, "left")
    value = _value(F.col("measure"), *[F.col(c) for c in (*SUMS, "n_keys")])
    return met.select("measure", "dimension", "member", value.alias("value"))


def totals(cube: DataFrame) -> DataFrame:
    """(measure, value) of all measures, unfiltered."""
    return answers(cube, [Question(name) for name in MEASURES]).select("measure", "value")
