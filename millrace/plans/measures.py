"""Eight named measures over the star schema, and the bounded way to ask for them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.ratios import safe_ratio

DELIVERED = "DELIVERED"
OVERRIDE, INTERSECT = "override", "intersect"


class UnknownRequest(ValueError):
    """A measure or a filter dimension outside the allowed set."""


def _delivered() -> Column:
    return F.count_if(F.col("status") == DELIVERED)


def _rows() -> Column:
    return F.count(F.lit(1))


@dataclass(frozen=True)
class Measure:
    """`fact` is the table the aggregate runs on."""

    name: str
    fact: str

    def value(self) -> Column:
        return _EXPRESSIONS[self.name]().cast("double").alias("value")


# Expressions are built on use: a Column needs a running session.
_EXPRESSIONS = {
    "Total Revenue": lambda: F.coalesce(F.sum("line_value"), F.lit(0)),
    "Total Orders": lambda: F.count_distinct("order_id"),
    "Order Lines": _rows,
    "Avg Line Value": lambda: safe_ratio(F.sum("line_value"), _rows()),
    "Active Products": lambda: F.count_distinct(F.when(F.col("is_active"), F.col("product_id"))),
    "Total Deliveries": _rows,
    "Delivery Success Rate": lambda: safe_ratio(_delivered(), _rows()),
    "Cold Chain Breaches": lambda: F.count_if(F.col("temperature_breach_flag")),
}
MEASURES = {
    m.name: m
    for m in (
        Measure("Total Revenue", "fact_orders"),
        Measure("Total Orders", "fact_orders"),
        Measure("Order Lines", "fact_orders"),
        Measure("Avg Line Value", "fact_orders"),
        Measure("Active Products", "dim_product"),
        Measure("Total Deliveries", "fact_deliveries"),
        Measure("Delivery Success Rate", "fact_deliveries"),
        Measure("Cold Chain Breaches", "fact_deliveries"),
    )
}
# Allowed filter dimensions and the table that holds each.
DIMENSIONS = {
    "region": "dim_depot",
    "city": "dim_depot",
    "category": "dim_product",
    "temperature_zone": "dim_product",
    "status": "fact_deliveries",
}
# The many-to-one relationships a filter travels along: (fact, dimension) to key.
RELATIONSHIPS = {
    ("fact_orders", "dim_depot"): "depot_id",
    ("fact_orders", "dim_product"): "product_id",
    ("fact_deliveries", "dim_depot"): "depot_id",
}


def known_measure(name: str) -> Measure:
    if name not in MEASURES:
        raise UnknownRequest(f"unknown measure {name!r}; allowed: {', '.join(MEASURES)}")
    return MEASURES[name]


def dimension_table(dimension: str) -> str:
    if dimension not in DIMENSIONS:
        raise UnknownRequest(f"unknown dimension {dimension!r}; allowed: {', '.join(DIMENSIONS)}")
    return DIMENSIONS[dimension]


def evaluate(gold: Mapping[str, DataFrame], name: str) -> DataFrame:
    """(measure, value) over the unfiltered star."""
    m = known_measure(name)
    return gold[m.fact].agg(m.value()).select(F.lit(name).alias("measure"), "value")


def all_measures(gold: Mapping[str, DataFrame]) -> DataFrame:
    """(measure, value) for all eight; each table is aggregated once."""
    parts = []
    for fact in ("fact_orders", "dim_product", "fact_deliveries"):
        own = [m for m in MEASURES.values() if m.fact == fact]
        sums = gold[fact].agg(*[m.value().alias(f"m{i}") for i, m in enumerate(own)])
        lines = [F.struct(F.lit(m.name).alias("measure"), F.col(f"m{i}").alias("value"))
                 for i, m in enumerate(own)]
        parts.append(sums.select(F.explode(F.array(*lines)).alias("x")).select("x.*"))
    return reduce(DataFrame.unionByName, parts)


def _filtered_fact(gold: Mapping[str, DataFrame], fact: str, dimension: str, value: str) -> DataFrame:
    """Rows of `fact` under a filter; all rows if the filter cannot reach it."""
    table = DIMENSIONS[dimension]
    chosen = F.col(dimension) == F.lit(value)
    if table == fact:
        return gold[fact].filter(chosen)
    key = RELATIONSHIPS.get((fact, table))
    if key is None:
        return gold[fact]
    return gold[fact].join(gold[table].filter(chosen).select(key), key, "left_semi")


def query_metric(
    gold: Mapping[str, DataFrame],
    measure: str,
    filter: dict[str, str] | None = None,
    model: str = "gold_star",
    filter_mode: str = OVERRIDE,
) -> DataFrame:
    """(measure, value, grounded_from) for an allowed measure under an optional filter.

    `filter` is {"dimension": ..., "value": ...}. The success rate fixes the
    status of its numerator. With a status filter, `override` lets that fixed
    status replace the filter in the numerator, so the rate may exceed 1;
    `intersect` applies both.
    """
    m = known_measure(measure)
    if filter_mode not in (OVERRIDE, INTERSECT):
        raise UnknownRequest(f"unknown filter mode {filter_mode!r}")
    if filter is None:
        answer = evaluate(gold, measure)
    else:
        if set(filter) != {"dimension", "value"}:
            raise UnknownRequest("a filter has exactly a dimension and a value")
        dimension_table(filter["dimension"])
        answer = _filtered(gold, m, filter["dimension"], filter["value"], filter_mode)
    return answer.withColumn("grounded_from", F.lit(model))


def _filtered(gold, m: Measure, dimension: str, value: str, mode: str) -> DataFrame:
    if m.name == "Delivery Success Rate" and dimension == "status" and mode == OVERRIDE:
        in_filter = F.count_if(F.col("status") == F.lit(value))
        rate = safe_ratio(_delivered(), in_filter).alias("value")
        answer = gold[m.fact].agg(rate)
    else:
        answer = _filtered_fact(gold, m.fact, dimension, value).agg(m.value())
    return answer.select(F.lit(m.name).alias("measure"), "value")


def measure_by(gold: Mapping[str, DataFrame], measure: str, dimension: str) -> DataFrame:
    """(member, value): the measure for each member of an allowed dimension.

    Facts without a parent fall under the NULL member. A dimension that the
    measure's table cannot be reached from yields the unfiltered value for
    every member.
    """
    m, table = known_measure(measure), dimension_table(dimension)
    if table == m.fact:
        return gold[m.fact].groupBy(F.col(dimension).alias("member")).agg(m.value())
    key = RELATIONSHIPS.get((m.fact, table))
    if key is None:
        members = gold[table].select(F.col(dimension).alias("member")).distinct()
        return members.withColumn("value", gold[m.fact].agg(m.value()).scalar())
    attribute = gold[table].select(key, F.col(dimension).alias("member"))
    return gold[m.fact].join(attribute, key, "left").groupBy("member").agg(m.value())


def audit(answer: DataFrame, filter: dict[str, str] | None, table: str | None = None,
          path: str | None = None) -> DataFrame:
    """Append the answer to an audit log (runs a job) and return a scan of the log.

    The log holds time, measure, filter and value of each call.
    """
    wanted = filter or {}
    line = answer.select(
        F.current_timestamp().alias("asked_at"), "measure",
        F.lit(wanted.get("dimension")).cast("string").alias("dimension"),
        F.lit(wanted.get("value")).cast("string").alias("filter_value"), "value",
    )
    writer = line.write.mode("append").format("parquet")
    if path is not None:
        writer.save(path)
        return answer.sparkSession.read.schema(line.schema).parquet(path)
    writer.saveAsTable(table or "metric_audit")
    return answer.sparkSession.table(table or "metric_audit")


# Questions that users ask, in normal form, and the measure that answers each.
QUESTIONS = {
    "how much revenue did we make": "Total Revenue",
    "how many products are active": "Active Products",
    "what share of deliveries succeeds": "Delivery Success Rate",
    "how often was the cold chain broken": "Cold Chain Breaches",
    "how much is an order line worth on average": "Avg Line Value",
}


def normal_form(text: Column) -> Column:
    """Lower case, letters and digits only, single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def answer_questions(questions: DataFrame, column: str, gold: Mapping[str, DataFrame]) -> DataFrame:
    """Join asked questions to the measure and value that answer them (NULL if none does)."""
    spark = questions.sparkSession
    known = spark.createDataFrame(list(QUESTIONS.items()), "_question string, measure string")
    asked = questions.withColumn("_norm", normal_form(F.col(column)))
    mapped = asked.join(known, F.col("_norm") == F.col("_question"), "left").drop("_norm", "_question")
    return mapped.join(all_measures(gold), "measure", "left")
