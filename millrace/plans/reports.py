"""Result tables behind the executive, operations and quality pages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.ratios import percent, safe_ratio
from millrace.operators.aggregates import with_share
from millrace.operators.rules import register_frame
from millrace.plans.silver import REGISTER


def kpi_exec(gold: Mapping[str, DataFrame]) -> DataFrame:
    """One row: revenue, orders, lines, customers, average line, products by state."""
    orders = gold["fact_orders"].agg(
        F.sum("line_value").cast("decimal(22,2)").alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("order_lines"),
        F.count_distinct("customer_id").alias("customers"),
    )
    products = gold["dim_product"].agg(
        F.struct(
            F.count_distinct(F.when(F.col("is_active"), F.col("product_id"))).alias("active"),
            F.count_distinct("category").alias("categories"),
            F.count_if(~F.col("is_active")).alias("withdrawn"),
        )
    ).scalar()
    return orders.withColumn("_p", products).select(
        "revenue", "orders", "order_lines", "customers",
        safe_ratio(F.col("revenue"), F.col("order_lines")).alias("avg_line_value"),
        F.col("_p.active").alias("active_products"),
        F.col("_p.categories").alias("product_categories"),
        F.col("_p.withdrawn").alias("withdrawn_products"),
    )


def kpi_ops(fact_deliveries: DataFrame, ungated_deliveries: DataFrame) -> DataFrame:
    """One row of delivery figures; unknown breaches are counted before the gate."""
    unknown = ungated_deliveries.agg(F.count_if(F.col("temperature_breach_flag").isNull())).scalar()
    kpis = fact_deliveries.agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.count_if(F.col("status") == "DELIVERED").alias("delivered"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.sum("transit_minutes").alias("_minutes"),
        F.count_if(F.col("temperature_breach_flag")).alias("breaches"),
    )
    return kpis.select(
        "deliveries", "delivered", percent(F.col("delivered"), F.col("deliveries")).alias("delivered_pct"),
        "failed", percent(F.col("failed"), F.col("deliveries")).alias("failed_pct"),
        safe_ratio(F.col("_minutes"), F.col("deliveries")).alias("avg_transit"),
        "breaches", unknown.alias("unknown_breaches"),
    )


def _totals_by(facts: DataFrame, dimension: DataFrame, key: str, attribute: str, value: str) -> DataFrame:
    members = dimension.select(key, attribute)
    return facts.join(members, key, "left").groupBy(attribute).agg(
        F.sum(value).cast("decimal(22,2)").alias("revenue")
    )


def revenue_by_region(gold: Mapping[str, DataFrame]) -> DataFrame:
    """(region, revenue, share), largest first."""
    totals = _totals_by(gold["fact_orders"], gold["dim_depot"], "depot_id", "region", "line_value")
    return with_share(totals, "revenue").orderBy(F.desc("revenue"), "region")


def revenue_by_category(gold: Mapping[str, DataFrame]) -> DataFrame:
    """(category, revenue, share) over active and withdrawn products."""
    totals = _totals_by(gold["fact_orders"], gold["dim_product"], "product_id", "category", "line_value")
    return with_share(totals, "revenue").orderBy(F.desc("revenue"), "category")


def status_mix(fact_deliveries: DataFrame) -> DataFrame:
    """(status, deliveries, share)."""
    counts = fact_deliveries.groupBy("status").agg(F.count(F.lit(1)).alias("deliveries"))
    return with_share(counts, "deliveries").orderBy(F.desc("deliveries"), "status")


def register_with_counts(results: DataFrame) -> DataFrame:
    """The rule register beside what this run found; NULL counts where nothing is checked."""
    found = results.select("rule", "violations", "rows_rejected", "status")
    return register_frame(results.sparkSession, REGISTER).join(found, "rule", "left")


def quality_page(results: DataFrame, totals: DataFrame) -> DataFrame:
    """Checked rules with counts and verdicts, each beside the load's totals."""
    whole = totals.select(
        F.struct("rows_in", "rows_quarantined", "quarantine_pct", F.col("status").alias("gate"))
    ).scalar()
    checked = register_with_counts(results).filter(F.col("violations").isNotNull())
    return checked.withColumn("_t", whole).select(
        "rule", "table", "column", "action", "violations", "status",
        F.col("_t.rows_in").alias("rows_in"), F.col("_t.rows_quarantined").alias("rows_quarantined"),
        F.col("_t.quarantine_pct").alias("quarantine_pct"), F.col("_t.gate").alias("gate"),
    )
