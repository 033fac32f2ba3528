"""Cleansing projections and scalar functions, over the tables in their raw text form."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import gold, query, silver, tagged
from millrace.functions import cleanse as c
from millrace.operators.references import one_per_key
from millrace.operators.tagging import rejected, survivors, tag
from millrace.plans import gold as gold_plan
from millrace.plans.silver import MASTER_PRICE, product_rules, type_deliveries
from millrace.sources.raw import as_text


def _spoilt(df, column: str, key: str):
    """Text form with a word where a value should be, on some rows."""
    text = as_text(df)
    return text.withColumn(column, F.when(F.col(key).cast("bigint") % 97 == 5, "n/a").otherwise(F.col(column)))


def _spoilt_sql(table: str, column: str, key: str, as_type: str, extra: str = "") -> str:
    text = f"case when {key} % 97 = 5 then 'n/a' else cast({column} as varchar) end"
    return f"""
select {key}, {extra} try_cast({text} as {as_type}) as parsed,
       ({text}) is not null and try_cast({text} as {as_type}) is null as lost
from {table}"""


def _parsed(df, column: str, key: str, parse, extra: tuple = ()):
    text = _spoilt(df, column, key)
    return text.select(
        F.col(key).cast("bigint").alias(key), *extra, parse(column).alias("parsed"),
        c.lost_by_parsing(column, parse(column)).alias("lost"),
    )


@query("cast_double", _spoilt_sql("lines_raw", "unit_price", "order_id", "double", "order_line_id,"))
def _(r):
    return _parsed(r.order_lines, "unit_price", "order_id", c.to_double, ("order_line_id",))


@query("cast_int", _spoilt_sql("products_raw", "shelf_life_days", "product_id", "integer"))
def _(r):
    return _parsed(r.products, "shelf_life_days", "product_id", c.to_int)


@query("cast_boolean", _spoilt_sql("deliveries_raw", "temperature_breach_flag", "delivery_id", "boolean"))
def _(r):
    return _parsed(r.deliveries, "temperature_breach_flag", "delivery_id", c.to_boolean)


@query("parse_date", _spoilt_sql("lines_raw", "requested_delivery_date", "order_id", "date", "order_line_id,"))
def _(r):
    return _parsed(r.order_lines, "requested_delivery_date", "order_id", c.to_date, ("order_line_id",))


@query("parse_timestamp", _spoilt_sql("deliveries_raw", "delivered_at", "delivery_id", "timestamp"))
def _(r):
    return _parsed(r.deliveries, "delivered_at", "delivery_id", c.to_timestamp)


@query("conform_title", "select depot_id, city from depots_s")
def _(r):
    return r.depots.select("depot_id", c.conform_title("city").alias("city"))


@query("conform_upper", "select delivery_id, status from deliveries_t")
def _(r):
    return r.deliveries.select("delivery_id", c.conform_upper("status").alias("status"))


@query("type_deliveries", """
select cast(delivery_id as varchar) as delivery_id, status, dispatched_at, delivered_at,
       temperature_breach_flag, cast(distance_km as double) as distance_km
from deliveries_t""")
def _(r):
    return type_deliveries(as_text(r.deliveries)).drop("order_id", "depot_id", "vehicle_id")


@query("money_decimal", """
select p_partkey, cast(p_retailprice as decimal(10,2)) as price, cast(p_size as decimal(10,2)) as size_money from part""")
def _(r):
    return r.source("part").select(
        "p_partkey", c.as_money("p_retailprice").alias("price"), c.as_money("p_size").alias("size_money")
    )


@query("ts_microseconds", "select event_id, ts from events")
def _(r):
    return r.source("events").select("event_id", c.to_microseconds("ts").alias("ts"))


@query("line_value", """
select order_line_id, quantity, cast(quantity * unit_price as decimal(12,2)) as line_value from lines_raw""")
def _(r):
    return r.order_lines.select("order_line_id", "quantity", c.line_value("quantity", "unit_price").alias("line_value"))


@query("transit_minutes", """
select delivery_id, cast(date_diff('minute', dispatched_at + to_seconds(50), delivered_at) as integer) as minutes
from deliveries_raw""")
def _(r):
    shifted = F.col("dispatched_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(50))
    return r.deliveries.select("delivery_id", c.minutes_between(shifted, F.col("delivered_at")).alias("minutes"))


@query("rename_project", "select order_line_id, ordered_at, quantity, line_value from fact_orders_ungated")
def _(r):
    staged = gold_plan.fact_orders(gold_plan.stg_orders(r.order_lines))
    return staged.select("order_line_id", "ordered_at", "quantity", "line_value")


@query("constant_flag", "select product_id, is_active from dim_product")
def _(r):
    return gold(r)["dim_product"].select("product_id", "is_active")


@query("dq_annotate", """
select product_id, unit_cost, unit_price, 'products' as _dq_table, 'R2' as _dq_rule,
       'a product is not sold below cost' as _dq_reason
from products_raw where unit_cost > unit_price""")
def _(r):
    judged = tag(r.products, "products", [product_rules()[1]])
    return rejected(judged).drop("product_name", "category", "temperature_zone", "shelf_life_days")


@query("dq_flag", "select order_line_id, quantity, _dq_r5, _dq_r17 from lines_s")
def _(r):
    return silver(r)["orders"].select("order_line_id", "quantity", "_dq_r5", "_dq_r17")


@query("drop_helper", "select * from lines_s")
def _(r):
    orders = tagged(r)["orders"]
    assert MASTER_PRICE in orders.helpers
    return survivors(orders)


@query("round_money", """
select order_line_id, l.unit_price, p.unit_price as master_price, l.unit_price <> p.unit_price as differs
from lines_raw l join products_one p on l.product_id = p.product_id""")
def _(r):
    master = one_per_key(r.products, "product_id").select("product_id", F.col("unit_price").alias("master_price"))
    return r.order_lines.join(master, "product_id").select(
        "order_line_id", "unit_price", "master_price", c.money_differs("unit_price", "master_price").alias("differs")
    )


@query("null_safe_bool", """
select delivery_id, coalesce(temperature_breach_flag, false) as breached from deliveries_raw""")
def _(r):
    return r.deliveries.select("delivery_id", c.is_true(F.col("temperature_breach_flag")).alias("breached"))
