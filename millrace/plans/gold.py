"""Staging models, the star schema, and its tests."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import cleanse as c
from millrace.operators.checks import TableTest
from millrace.operators.references import fk_report, one_per_key, orphans
from millrace.sources.snapshots import SnapshotStore, name_views
from millrace.sources.tables import Frames

PRODUCT_COLUMNS = ("product_id", "product_name", "category", "temperature_zone")


def stg_orders(silver_orders: DataFrame) -> DataFrame:
    return silver_orders.select(
        "order_line_id", "order_id", "customer_id", "depot_id", "product_id",
        c.to_microseconds("order_datetime").alias("ordered_at"),
        F.col("requested_delivery_date").cast("date").alias("requested_delivery_date"),
        F.col("quantity").cast("int").alias("quantity"),
        c.as_money("unit_price").alias("unit_price"),
        c.line_value("quantity", "unit_price").alias("line_value"),
    )


def stg_deliveries(silver_deliveries: DataFrame) -> DataFrame:
    return silver_deliveries.select(
        "delivery_id", "order_id", "depot_id", "vehicle_id",
        c.to_microseconds("dispatched_at").alias("dispatched_at"),
        c.to_microseconds("delivered_at").alias("delivered_at"),
        "status", "temperature_breach_flag",
        c.as_money("distance_km").alias("distance_km"),
        c.minutes_between("dispatched_at", "delivered_at").alias("transit_minutes"),
    )


def fact_orders(staged: DataFrame) -> DataFrame:
    """Grain: one order line."""
    return staged.select(
        "order_line_id", "order_id", "customer_id", "depot_id", "product_id", "ordered_at",
        "requested_delivery_date", "quantity", "unit_price", "line_value",
    )


def fact_deliveries(staged: DataFrame) -> DataFrame:
    """Grain: one delivery."""
    return staged.select(
        "delivery_id", "order_id", "depot_id", "vehicle_id", "dispatched_at", "delivered_at",
        "status", "temperature_breach_flag", "distance_km", "transit_minutes",
    )


def dim_depot(silver_depots: DataFrame) -> DataFrame:
    return silver_depots.select(
        "depot_id", "depot_name", "city", "region", "capacity_pallets", "opened_date"
    )


def _members(products: DataFrame, active: bool) -> DataFrame:
    return products.select(
        *PRODUCT_COLUMNS,
        c.as_money("unit_cost").alias("unit_cost"),
        c.as_money("unit_price").alias("unit_price"),
        F.col("shelf_life_days").cast("int").alias("shelf_life_days"),
        F.lit(active).alias("is_active"),
    )


def withdrawn_products(silver_products: DataFrame, bronze_products: DataFrame) -> DataFrame:
    """Members the source still knows but silver rejected, as inactive; one version of each key."""
    known = one_per_key(_members(bronze_products, False), "product_id")
    return orphans(known, "product_id", silver_products, "product_id", null_is_orphan=False)


def dim_product(silver_products: DataFrame, bronze_products: DataFrame) -> DataFrame:
    """Active members plus withdrawn ones, so facts keep their parent."""
    return _members(silver_products, True).unionByName(withdrawn_products(silver_products, bronze_products))


def build_gold(silver: Mapping[str, DataFrame], bronze_products: DataFrame) -> Frames:
    """The four marts as lazy frames."""
    return Frames({
        "fact_orders": lambda: fact_orders(stg_orders(silver["orders"])),
        "fact_deliveries": lambda: fact_deliveries(stg_deliveries(silver["deliveries"])),
        "dim_depot": lambda: dim_depot(silver["depots"]),
        "dim_product": lambda: dim_product(silver["products"], bronze_products),
    })


def publish_gold(gold: Mapping[str, DataFrame], prefix: str = "gold_", fmt: str = "parquet",
                 location: str | None = None, run_id: str | None = None) -> dict[str, DataFrame]:
    """Write the marts and commit them as one version (runs jobs); returns scans of it, under their names.

    All marts change together or none does. A run that committed before is not written again.
    """
    spark = next(iter(gold.values())).sparkSession
    store = SnapshotStore(spark, location or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{prefix}store", fmt)
    snapshot = store.publish(run_id or uuid.uuid4().hex, gold)
    return name_views(snapshot, {name: prefix + name for name in gold})


def soft_delete_proof(facts: DataFrame, silver_products: DataFrame, full_dimension: DataFrame) -> DataFrame:
    """Order lines without a product, before and after the withdrawn members return."""
    before = fk_report(facts, "product_id", silver_products, "product_id", "active members only")
    after = fk_report(facts, "product_id", full_dimension, "product_id", "with withdrawn members")
    return before.unionByName(after).select("check", "orphans", "distinct_bad_keys", "status")


def star_tests() -> list[TableTest]:
    """The thirteen tests that guard promotion of the star schema."""
    keys = {"fact_orders": "order_line_id", "fact_deliveries": "delivery_id",
            "dim_depot": "depot_id", "dim_product": "product_id"}
    tests = [TableTest(kind, table, key) for table, key in keys.items() for kind in ("unique", "not_null")]
    tests += [
        TableTest("relationships", "fact_orders", "depot_id", "dim_depot", "depot_id"),
        TableTest("relationships", "fact_orders", "product_id", "dim_product", "product_id"),
        TableTest("relationships", "fact_deliveries", "depot_id", "dim_depot", "depot_id"),
        TableTest("rows", "fact_orders", "line_value", bad=F.col("line_value") <= 0),
        TableTest("rows", "fact_deliveries", "transit_minutes, distance_km",
                  bad=(F.col("transit_minutes") < 0) | (F.col("distance_km") < 0)),
    ]
    return tests
