"""How a query is registered, and the SQL layers its oracle may read.

The SQL gates one rule after another, each on the survivors of the last, so it
shares no method with the one-pass gate it is compared to.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.plans import gold as gold_plan
from millrace.plans import silver as silver_plan
from millrace.session import apply_runtime_conf
from millrace.sources.retail import RetailTables


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[RetailTables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(RetailTables(apply_runtime_conf(spark), folder))


REGISTERED: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register a query; `sql` may read every layer below by name."""
    def add(build: Callable[[RetailTables], DataFrame]):
        if key in REGISTERED:
            raise ValueError(f"query {key!r} is registered twice")
        REGISTERED[key] = Query(key, build, None if sql is None else _with_layers(sql.strip()))
        return build
    return add


def _with_layers(body: str) -> str:
    """A body may bring its own `with`; its tables follow the layers."""
    if body.startswith("with "):
        return f"with {LAYERS},\n{body[5:]}"
    return f"with {LAYERS}\n{body}"


def typed(r: RetailTables) -> dict[str, DataFrame]:
    return silver_plan.conform(r.all)


def tagged(r: RetailTables):
    return silver_plan.tag_all(typed(r))


def silver(r: RetailTables) -> dict[str, DataFrame]:
    return silver_plan.silver(typed(r))


def gold(r: RetailTables) -> dict[str, DataFrame]:
    return gold_plan.build_gold(silver(r), r.products)


def ungated_gold(r: RetailTables) -> dict[str, DataFrame]:
    """The star over rows that no contract has judged."""
    return gold_plan.build_gold(typed(r), r.products)


def pct(part: str, whole: str) -> str:
    """SQL of a percentage at two decimals, in integers."""
    p, w = f"cast({part} as bigint)", f"cast({whole} as bigint)"
    return (f"cast(case when coalesce({w}, 0) = 0 then 0 "
            f"else cast(({p} * 20000 + {w}) // (2 * {w}) as decimal(18,0)) * 0.01 end as decimal(18,2))")


def ratio(n: str, d: str) -> str:
    n, d = f"cast({n} as double)", f"cast({d} as double)"
    return f"(case when {d} is null or {d} = 0 then cast(0 as double) else {n} / {d} end)"


_RAW = """
lines_base as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, o_custkey, o_orderdate,
         cast(p_retailprice as decimal(10,2)) as list_price,
         l_orderkey * 31 + l_linenumber * 17 as h
  from lineitem
  join orders on l_orderkey = o_orderkey
  join part on l_partkey = p_partkey),
lines_copied as (
  select *, unnest(case when h % 190 = 21 then [0, 1] else [0] end) as copy_no,
         case when h % 230 = 9 then cast(-(h % 11) as integer) else cast(l_quantity as integer) end as qty
  from lines_base),
lines_raw as (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as order_line_id,
         l_orderkey as order_id, o_custkey as customer_id,
         case when h % 170 = 4 then h % 4 + 770000 else l_suppkey end as depot_id,
         l_partkey as product_id, o_orderdate as order_datetime,
         case when h % 95 <> 11 then cast(o_orderdate as date) + cast(h % 9 + 2 as integer) end
           as requested_delivery_date,
         case when copy_no = 1 and h % 2090 = 21 then qty + 1 else qty end as quantity,
         case when h % 52 = 15 then cast(list_price * (h % 80 + 61) * 0.01 as decimal(10,2))
              else list_price end as unit_price
  from lines_copied),
products_base as (
  select *, cast(p_retailprice as decimal(10,2)) as list_price,
         unnest(case when p_partkey % 330 in (5, 111) then [0, 1] else [0] end) as copy_no
  from part),
products_cost as (
  select *, cast(list_price * 0.64 as decimal(10,2)) as cost from products_base),
products_raw as (
  select p_partkey as product_id, p_name as product_name, p_brand as category,
         p_type as temperature_zone, cost as unit_cost,
         case when p_partkey % 19 = 6 then cast(cost * 0.93 as decimal(10,2)) else list_price end as unit_price,
         p_size + case when copy_no = 1 and p_partkey % 330 = 111 then 1 else 0 end as shelf_life_days
  from products_cost),
products_one as (
  select distinct on (product_id) * from products_raw
  order by product_id, product_name, category, temperature_zone, unit_cost, unit_price, shelf_life_days),
depots_raw as (
  select s_suppkey as depot_id, s_name as depot_name,
         case when s_suppkey % 14 = 3 then ' ' || lower(n_name)
              when s_suppkey % 14 = 9 then upper(n_name) else n_name end as city,
         r_name as region, s_suppkey % 1500 + 250 as capacity_pallets,
         date '2011-03-01' + cast(s_suppkey % 4100 as integer) as opened_date
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
deliveries_base as (
  select o_orderkey as k, o_orderdate, depot, o_orderkey * 13 + 3 as g
  from orders
  join (select l_orderkey, min(l_suppkey) as depot from lineitem group by l_orderkey) on o_orderkey = l_orderkey),
deliveries_copied as (
  select *, unnest(case when g % 185 = 16 then [0, 1] else [0] end) as copy_no,
         o_orderdate + to_days(cast(g % 6 + 1 as integer)) + to_hours(cast(g % 9 + 3 as integer)) as sent,
         cast((g % 1700 + 22) * 0.1 as decimal(10,2)) as km
  from deliveries_base),
deliveries_raw as (
  select k + copy_no * 1000000000 as delivery_id, k + copy_no * 1000000000 as order_id,
         depot as depot_id, k % 90 + 1 as vehicle_id, sent as dispatched_at,
         case when g % 131 = 12 then sent - interval 95 minutes
              else sent + to_minutes(cast(g % 410 + 25 as integer)) end as delivered_at,
         case when k % 90 >= 84 then 'SCHEDULED'
              when g % 23 = 7 then ['delivered', 'Delivered', ' DELIVERED', 'DELIVERED ', 'failed'][g % 5 + 1]
              when g % 100 < 83 then 'DELIVERED' when g % 100 < 91 then 'FAILED'
              when g % 100 < 96 then 'RETURNED' else 'PARTIAL' end as status,
         case when g % 49 <> 5 then g % 31 = 2 end as temperature_breach_flag,
         case when g % 310 = 14 then -km else km end as distance_km
  from deliveries_copied)"""

_SEQUENTIAL_GATE = """
depots_s as (
  select depot_id, depot_name, upper(left(trim(city), 1)) || lower(substr(trim(city), 2)) as city,
         region, capacity_pallets, opened_date from depots_raw),
deliveries_t as (select * replace (upper(trim(status)) as status) from deliveries_raw),
products_d as (select distinct * from products_raw),
r1_keys as (select product_id from products_d where product_id is not null group by 1 having count(*) > 1),
r1_bad as (select * from products_d semi join r1_keys using (product_id)),
products_1 as (select * from products_d anti join r1_keys using (product_id)),
r2_bad as (select * from products_1 where unit_cost > unit_price),
products_s as (select * from products_1 where not coalesce(unit_cost > unit_price, false)),
lines_d as (select distinct * from lines_raw),
r4_keys as (select order_line_id from lines_d group by 1 having count(*) > 1),
r4_bad as (select * from lines_d semi join r4_keys using (order_line_id)),
lines_1 as (
  select *, requested_delivery_date is null as _dq_r5 from lines_d anti join r4_keys using (order_line_id)),
r6_bad as (select * from lines_1 where quantity <= 0),
lines_2 as (select * from lines_1 where not coalesce(quantity <= 0, false)),
r7_bad as (select * from lines_2 anti join depots_raw using (depot_id)),
lines_3 as (select * from lines_2 semi join depots_raw using (depot_id)),
lines_m as (
  select l.*, p.unit_price as master_price from lines_3 l left join products_s p on l.product_id = p.product_id),
r8_bad as (select * from lines_m where master_price is not null and unit_price <> master_price),
lines_4 as (
  select *, master_price is null as _dq_r17 from lines_m where master_price is null or unit_price = master_price),
lines_s as (select * exclude (master_price) from lines_4),
r10_bad as (select * from deliveries_t anti join lines_s using (order_id)),
deliveries_1 as (select * from deliveries_t semi join lines_s using (order_id)),
r12_bad as (select * from deliveries_1 where temperature_breach_flag is null),
deliveries_2 as (select * from deliveries_1 where temperature_breach_flag is not null),
r13_bad as (select * from deliveries_2 where delivered_at < dispatched_at),
deliveries_3 as (select * from deliveries_2 where not (delivered_at < dispatched_at)),
r14_bad as (select * from deliveries_3 where distance_km < 0),
deliveries_s as (select * from deliveries_3 where not (distance_km < 0)),
rule_counts(rule, "table", action, violations, rows_rejected) as (
  select 'R1', 'products', 'FAIL', (select count(*) from r1_keys), (select count(*) from r1_bad) union all
  select 'R2', 'products', 'FAIL', count(*), count(*) from r2_bad union all
  select 'R4', 'orders', 'FAIL', (select count(*) from r4_keys), (select count(*) from r4_bad) union all
  select 'R5', 'orders', 'WARN', count(*), 0 from lines_1 where _dq_r5 union all
  select 'R6', 'orders', 'FAIL', count(*), count(*) from r6_bad union all
  select 'R7', 'orders', 'FAIL', count(*), count(*) from r7_bad union all
  select 'R8', 'orders', 'FAIL', count(*), count(*) from r8_bad union all
  select 'R17', 'orders', 'WARN', count(*), 0 from lines_4 where _dq_r17 union all
  select 'R10', 'deliveries', 'FAIL', count(*), count(*) from r10_bad union all
  select 'R12', 'deliveries', 'FAIL', count(*), count(*) from r12_bad union all
  select 'R13', 'deliveries', 'FAIL', count(*), count(*) from r13_bad union all
  select 'R14', 'deliveries', 'FAIL', count(*), count(*) from r14_bad),
total_in as (
  select (select count(*) from products_raw) + (select count(*) from depots_raw)
       + (select count(*) from lines_raw) + (select count(*) from deliveries_raw) as n),
rejected_all(_dq_table, _dq_rule, row_key) as (
  select 'products', 'R1', cast(product_id as varchar) from r1_bad union all
  select 'products', 'R2', cast(product_id as varchar) from r2_bad union all
  select 'orders', 'R4', order_line_id from r4_bad union all
  select 'orders', 'R6', order_line_id from r6_bad union all
  select 'orders', 'R7', order_line_id from r7_bad union all
  select 'orders', 'R8', order_line_id from r8_bad union all
  select 'deliveries', 'R10', cast(delivery_id as varchar) from r10_bad union all
  select 'deliveries', 'R12', cast(delivery_id as varchar) from r12_bad union all
  select 'deliveries', 'R13', cast(delivery_id as varchar) from r13_bad union all
  select 'deliveries', 'R14', cast(delivery_id as varchar) from r14_bad)"""


def _star(suffix: str, lines: str, deliveries: str, products: str) -> str:
    return f"""
fact_orders{suffix} as (
  select order_line_id, order_id, customer_id, depot_id, product_id, order_datetime as ordered_at,
         requested_delivery_date, quantity, unit_price,
         cast(quantity * unit_price as decimal(12,2)) as line_value
  from {lines}),
fact_deliveries{suffix} as (
  select *, cast(date_diff('minute', dispatched_at, delivered_at) as integer) as transit_minutes
  from {deliveries}),
dim_product{suffix} as (
  select *, true as is_active from {products}
  union all
  select *, false from products_one where product_id not in (select product_id from {products})),
measures{suffix}(measure, value) as (
  select 'Total Revenue', cast(coalesce(sum(line_value), 0) as double) from fact_orders{suffix} union all
  select 'Total Orders', cast(count(distinct order_id) as double) from fact_orders{suffix} union all
  select 'Order Lines', cast(count(*) as double) from fact_orders{suffix} union all
  select 'Avg Line Value', {ratio('sum(line_value)', 'count(*)')} from fact_orders{suffix} union all
  select 'Active Products', cast(count(distinct product_id) filter (where is_active) as double)
    from dim_product{suffix} union all
  select 'Total Deliveries', cast(count(*) as double) from fact_deliveries{suffix} union all
  select 'Delivery Success Rate', {ratio("count(*) filter (where status = 'DELIVERED')", 'count(*)')}
    from fact_deliveries{suffix} union all
  select 'Cold Chain Breaches', cast(count(*) filter (where temperature_breach_flag) as double)
    from fact_deliveries{suffix})"""


LAYERS = ",".join([
    _RAW,
    _SEQUENTIAL_GATE,
    _star("", "lines_s", "deliveries_s", "products_s"),
    _star("_ungated", "lines_raw", "deliveries_t", "products_raw"),
])
