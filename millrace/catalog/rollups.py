"""Aggregations, sorts, top-k, set operations and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import gold, pct, query, silver, tagged, typed
from millrace.functions.ratios import safe_ratio
from millrace.operators import aggregates, gate, profile, rules
from millrace.operators.references import fk_report
from millrace.plans import reports
from millrace.sources.raw import as_text

# --- aggregations --------------------------------------------------------------------------


@query("count_rows", "select count(*) as n_rows from fact_orders")
def _(r):
    return gold(r)["fact_orders"].agg(F.count(F.lit(1)).alias("n_rows"))


@query("group_having", """
select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1""")
def _(r):
    return aggregates.group_having(r.source("lineitem"), ["l_orderkey", "l_linenumber"])


@query("count_distinct", "select count(distinct order_id) as orders, count(distinct customer_id) as customers from lines_raw")
def _(r):
    return r.order_lines.agg(F.count_distinct("order_id").alias("orders"),
                             F.count_distinct("customer_id").alias("customers"))


@query("group_min", "select order_id, min(order_datetime) as first_at from lines_raw group by 1")
def _(r):
    return r.order_lines.groupBy("order_id").agg(F.min("order_datetime").alias("first_at"))


@query("order_header", """
select order_id, depot_id, order_datetime, requested_delivery_date, n_lines from (
  select *, count(*) over (partition by order_id) as n_lines,
         row_number() over (partition by order_id order by order_line_id, depot_id, order_datetime,
                            requested_delivery_date nulls first) as pos
  from lines_d) where pos = 1""")
def _(r):
    values = ["depot_id", "order_datetime", "requested_delivery_date"]
    return aggregates.order_header(r.order_lines.distinct(), "order_id", ["order_line_id"], values)


@query("sum_revenue", "select cast(sum(line_value) as decimal(22,2)) as revenue from fact_orders")
def _(r):
    return gold(r)["fact_orders"].agg(F.sum("line_value").cast("decimal(22,2)").alias("revenue"))


@query("safe_ratio", """
select depot_id, case when q = 0 then 0.0::double else cast(v as double) / cast(q as double) end as value_per_unit
from (select depot_id, sum(quantity * unit_price) as v, sum(case when quantity > 0 then quantity else 0 end) as q
      from lines_raw group by 1)""")
def _(r):
    units = F.sum(F.when(F.col("quantity") > 0, F.col("quantity")).otherwise(0))
    return r.order_lines.groupBy("depot_id").agg(
        safe_ratio(F.sum(F.col("quantity") * F.col("unit_price")), units).alias("value_per_unit"))


@query("filtered_count", """
select depot_id, count(*) filter (where temperature_breach_flag) as breaches,
       count(*) filter (where status = 'DELIVERED') as delivered from deliveries_t group by 1""")
def _(r):
    return typed(r)["deliveries"].groupBy("depot_id").agg(
        F.count_if("temperature_breach_flag").alias("breaches"),
        F.count_if(F.col("status") == "DELIVERED").alias("delivered"))


@query("filtered_distinct", "select count(distinct product_id) filter (where is_active) as active from dim_product")
def _(r):
    return gold(r)["dim_product"].agg(F.count_distinct(F.when(F.col("is_active"), F.col("product_id"))).alias("active"))


@query("value_counts", """
select 'requested_delivery_date' as "column", cast(requested_delivery_date as varchar) as value, count(*) as n
from lines_raw group by 2 union all
select 'quantity', cast(quantity as varchar), count(*) from lines_raw group by 2""")
def _(r):
    return profile.frequencies(r.order_lines, ["requested_delivery_date", "quantity"])


@query("avg_transit", """
select status, count(*) as deliveries, cast(sum(transit_minutes) as double) / count(*) as avg_transit
from fact_deliveries group by 1""")
def _(r):
    return gold(r)["fact_deliveries"].groupBy("status").agg(
        F.count(F.lit(1)).alias("deliveries"),
        safe_ratio(F.sum("transit_minutes"), F.count(F.lit(1))).alias("avg_transit"))


@query("distinct_rows", "select distinct customer_id, depot_id from lines_raw")
def _(r):
    return r.order_lines.select("customer_id", "depot_id").distinct()


# --- sorts and top-k -----------------------------------------------------------------------

_REGION_REVENUE = """
select region, cast(sum(line_value) as decimal(22,2)) as revenue
from fact_orders left join depots_s using (depot_id) group by 1"""


@query("sort_desc", f"{_REGION_REVENUE} order by revenue desc, region")
def _(r):
    return reports.revenue_by_region(gold(r)).drop("share")


@query("top_k", """
select city, cast(sum(line_value) as decimal(22,2)) as revenue
from fact_orders left join depots_s using (depot_id) group by 1 order by revenue desc, city limit 6""")
def _(r):
    g = gold(r)
    by_city = g["fact_orders"].join(g["dim_depot"].select("depot_id", "city"), "depot_id", "left").groupBy("city").agg(
        F.sum("line_value").cast("decimal(22,2)").alias("revenue"))
    return aggregates.top_k(by_city, "revenue", ["city"], 6)


@query("head_sample", """
select order_line_id, quantity from lines_d where quantity <= 0 order by order_line_id, quantity limit 5""")
def _(r):
    rows = r.order_lines.select("order_line_id", "quantity").distinct()
    return rules.examples(rows, F.col("quantity") <= 0, ["order_line_id", "quantity"])


@query("top_values", """
select product_id as value, count(*) as n from lines_raw group by 1 order by n desc, value limit 20""")
def _(r):
    counts = r.order_lines.groupBy(F.col("product_id").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return aggregates.top_k(counts, "n", ["value"], 20)


@query("first_bad_keys", """
select distinct product_id from lines_raw where product_id not in (select product_id from products_s)
order by product_id limit 10""")
def _(r):
    report = fk_report(r.order_lines, "product_id", silver(r)["products"], "product_id", "orders to products")
    keys = F.split("first_bad_keys", ",").cast("array<bigint>")
    return report.select(F.explode(keys).alias("product_id"))


# --- set operations ------------------------------------------------------------------------


@query("union_by_name", """
select _dq_rule, order_line_id, null::bigint as delivery_id, product_id, unit_price, cast(null as decimal(10,2)) as distance_km
from (select 'R6' as _dq_rule, * from r6_bad) union all
select 'R14', null, delivery_id, null, null, distance_km from r14_bad""")
def _(r):
    t = tagged(r)
    held = gate.quarantine([t["orders"], t["deliveries"]]).filter(F.col("_dq_rule").isin("R6", "R14"))
    return held.select("_dq_rule", "order_line_id", "delivery_id", "product_id", "unit_price", "distance_km")


@query("union_all", "select is_active, count(*) as n from dim_product group by 1")
def _(r):
    return gold(r)["dim_product"].groupBy("is_active").agg(F.count(F.lit(1)).alias("n"))


@query("append_rows", """
select order_line_id, quantity from lines_raw union all select order_line_id, quantity from lines_s""")
def _(r):
    columns = ["order_line_id", "quantity"]
    return r.order_lines.select(*columns).union(silver(r)["orders"].select(*columns))


# --- profiles ------------------------------------------------------------------------------

_LINE_TYPES = {
    "order_line_id": "string", "order_id": "bigint", "customer_id": "bigint", "depot_id": "bigint",
    "product_id": "bigint", "order_datetime": "timestamp_ntz", "requested_delivery_date": "date",
    "quantity": "int", "unit_price": "decimal(10,2)",
}


@query("schema_audit", " union all ".join(f"""
select 'orders' as "table", '{c}' as "column", '{kind}' as dtype, count({c}) as non_null, count(*) - count({c}) as nulls,
       {pct(f'count(*) - count({c})', 'count(*)')} as null_pct, count(distinct {c}) as n_unique,
       min(cast({c} as varchar)) as sample from lines_raw""" for c, kind in _LINE_TYPES.items()))
def _(r):
    return profile.schema_audit(r.order_lines, "orders")


@query("missingness", f"""
select 'orders' as "table", 'requested_delivery_date' as "column",
       count(*) - count(requested_delivery_date) as nulls,
       {pct('count(*) - count(requested_delivery_date)', 'count(*)')} as pct from lines_raw
union all
select 'deliveries', 'temperature_breach_flag', count(*) - count(temperature_breach_flag),
       {pct('count(*) - count(temperature_breach_flag)', 'count(*)')} from deliveries_raw""")
def _(r):
    lines = profile.missingness(r.order_lines, "orders")
    return lines.unionByName(profile.missingness(r.deliveries, "deliveries"))


@query("missingness_by", f"""
select status, count(*) as n_rows, count(*) - count(temperature_breach_flag) as nulls,
       {pct('count(*) - count(temperature_breach_flag)', 'count(*)')} as null_pct
from deliveries_raw group by 1""")
def _(r):
    return profile.missingness_by(r.deliveries, "temperature_breach_flag", "status")


_NUMERIC = ("quantity", "unit_price", "depot_id")


def _numeric_sql(table: str, columns) -> str:
    return " union all ".join(f"""
select '{c}' as "column", min(x) as min, quantile_cont(x, 0.05) as p05, quantile_cont(x, 0.5) as median,
       quantile_cont(x, 0.95) as p95, max(x) as max, cast(avg(x) as decimal(38,2)) as mean,
       cast(skewness(x) as decimal(38,2)) as skew, count(*) filter (where x < 0) as n_negative,
       count(*) filter (where x = 0) as n_zero
from (select cast({c} as double) as x from {table})""" for c in columns)


@query("numeric_profile", _numeric_sql("lines_raw", _NUMERIC) + " union all " + _numeric_sql("deliveries_raw", ["distance_km"]))
def _(r):
    lines = profile.numeric_profile(r.order_lines, _NUMERIC)
    return lines.unionByName(profile.numeric_profile(r.deliveries, ["distance_km"]))


@query("histogram", " union all ".join(f"""
select '{c}' as "column", bin, lo + bin * width as low, count(*) as n, median from (
  select x, lo, width, median, cast(case when width = 0 then 0 else least(floor((x - lo) / width), 44) end as integer) as bin
  from (select cast({c} as double) as x from {t} where {c} is not null),
       (select min(cast({c} as double)) as lo, (max(cast({c} as double)) - min(cast({c} as double))) / 45 as width,
               quantile_cont(cast({c} as double), 0.5) as median from {t}))
group by bin, lo, width, median""" for t, c in
    (("lines_raw", "quantity"), ("lines_raw", "unit_price"), ("deliveries_raw", "distance_km"))))
def _(r):
    lines = profile.histogram(r.order_lines, ["quantity", "unit_price"])
    return lines.unionByName(profile.histogram(r.deliveries, ["distance_km"]))


def _categorical_sql(column: str) -> str:
    return f"""
select '{column}' as "column", d as n_distinct, cast(position as integer) as position, value, n from (
  select d, value, n, row_number() over (order by n desc, value nulls last) as position
  from (select {column} as value, count(*) as n from deliveries_text group by 1),
       (select count(distinct {column}) as d from deliveries_text))"""


@query("categorical_profile", f"""
with deliveries_text as (select columns(*)::varchar from deliveries_raw)
{_categorical_sql('status')} union all {_categorical_sql('vehicle_id')} union all {_categorical_sql('temperature_breach_flag')}""")
def _(r):
    return profile.categorical_profile(as_text(r.deliveries), ["status", "vehicle_id", "temperature_breach_flag"])


@query("type_suspects", """
with long as (
  unpivot (select cast(delivery_id as varchar) as delivery_id, status, cast(dispatched_at as varchar) as dispatched_at,
                  cast(temperature_breach_flag as varchar) as temperature_breach_flag,
                  cast(distance_km as varchar) as distance_km from deliveries_raw)
  on delivery_id, status, dispatched_at, temperature_breach_flag, distance_km into name "column" value value)
select "column", count(*) as non_null,
       count(*) filter (where try_cast(value as double) is not null) as as_number,
       count(*) filter (where value in ('true', 'false', '0', '1')) as as_boolean,
       count(*) filter (where regexp_matches(value, '^[0-9]{4}-[0-9]{1,2}') and try_cast(value as timestamp) is not null) as as_timestamp,
       case when as_number * 100.0 >= non_null * 95.0 then 'number'
            when as_boolean * 100.0 >= non_null * 95.0 then 'boolean'
            when as_timestamp * 100.0 >= non_null * 95.0 then 'timestamp' end as suspect
from long group by 1""")
def _(r):
    columns = ["delivery_id", "status", "dispatched_at", "temperature_breach_flag", "distance_km"]
    return profile.type_suspects(as_text(r.deliveries), columns)


@query("defect_register", """
select 'deliveries' as "table", 'status' as "column", 'spelling' as defect,
       count(*) filter (where status <> upper(trim(status))) as n_rows, 'CLEANSE' as action from deliveries_raw union all
select 'orders', 'quantity', 'zero or less', count(*) filter (where quantity <= 0), 'FAIL' from lines_raw union all
select 'orders', 'requested_delivery_date', 'missing',
       count(*) filter (where requested_delivery_date is null), 'WARN' from lines_raw union all
select 'orders', 'depot_id', 'orphan', count(*), 'FAIL' from lines_raw anti join depots_raw using (depot_id) union all
select 'deliveries', 'distance_km', 'negative', count(*) filter (where distance_km < 0), 'FAIL' from deliveries_raw union all
select 'deliveries', 'delivered_at', 'before dispatch',
       count(*) filter (where delivered_at < dispatched_at), 'FAIL' from deliveries_raw""")
def _(r):
    return profile.defect_register([
        profile.Finding("deliveries", "status", "spelling", rules.CLEANSE,
                        rules.conformance_gap(r.deliveries, "status").select("non_conforming")),
        profile.Finding("orders", "quantity", "zero or less", rules.FAIL, _violations(r.order_lines, F.col("quantity") <= 0)),
        profile.Finding("orders", "requested_delivery_date", "missing", rules.WARN,
                        _violations(r.order_lines, F.col("requested_delivery_date").isNull())),
        profile.Finding("orders", "depot_id", "orphan", rules.FAIL,
                        fk_report(r.order_lines, "depot_id", r.depots, "depot_id", "depot").select("orphans")),
        profile.Finding("deliveries", "distance_km", "negative", rules.FAIL,
                        _violations(r.deliveries, F.col("distance_km") < 0)),
        profile.Finding("deliveries", "delivered_at", "before dispatch", rules.FAIL,
                        _violations(r.deliveries, F.col("delivered_at") < F.col("dispatched_at"))),
    ])


def _violations(df, bad):
    return rules.check(df, bad, "").select("violations")
