"""Gold models, table tests, measures and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import gold, pct, query, ratio, silver, typed, ungated_gold
from millrace.operators import checks, drills, gate
from millrace.plans import gold as gold_plan
from millrace.plans import cube, measures, reports
from millrace.plans import silver as silver_plan
from millrace.session import work_folder
from millrace.sources.raw import as_text, export_csv, read_raw
from millrace.sources.tables import settle

# --- models --------------------------------------------------------------------------------


@query("stg_orders", "select * from fact_orders")
def _(r):
    return gold_plan.stg_orders(silver(r)["orders"])


@query("stg_deliveries", "select * from fact_deliveries")
def _(r):
    return gold_plan.stg_deliveries(silver(r)["deliveries"])


def _mart(name: str, sql: str):
    @query(name, sql)
    def _(r):
        return gold(r)[name]


_mart("fact_orders", "select * from fact_orders")
_mart("fact_deliveries", "select * from fact_deliveries")
_mart("dim_depot", "select * from depots_s")
_mart("dim_product", "select * from dim_product")


@query("recover_withdrawn", "select product_id, unit_cost, unit_price from dim_product where not is_active")
def _(r):
    gone = gold_plan.withdrawn_products(silver(r)["products"], r.products)
    return gone.select("product_id", "unit_cost", "unit_price")


@query("soft_delete_proof", """
select 'active members only' as "check", count(*) as orphans, count(distinct product_id) as distinct_bad_keys,
       case when count(*) = 0 then 'PASS' else 'FAIL' end as status
from fact_orders where product_id not in (select product_id from products_s) union all
select 'with withdrawn members', count(*), count(distinct product_id), case when count(*) = 0 then 'PASS' else 'FAIL' end
from fact_orders where product_id not in (select product_id from dim_product)""")
def _(r):
    kept = silver(r)
    g = gold_plan.build_gold(kept, r.products)
    return gold_plan.soft_delete_proof(g["fact_orders"], kept["products"], g["dim_product"])


@query("star_join", """
select order_line_id, region, category, is_active, line_value
from fact_orders left join depots_s using (depot_id) left join dim_product using (product_id)""")
def _(r):
    g = gold(r)
    depot = g["dim_depot"].select("depot_id", "region")
    product = g["dim_product"].select("product_id", "category", "is_active")
    joined = g["fact_orders"].join(depot, "depot_id", "left").join(product, "product_id", "left")
    return joined.select("order_line_id", "region", "category", "is_active", "line_value")


# --- table tests ---------------------------------------------------------------------------


def _test_sql(kind: str, table: str, column: str, failures: str) -> str:
    return f"""
select '{kind}' as test, '{table}' as "table", '{column}' as "column", ({failures}) as failures"""


_KEYS = (("fact_orders", "order_line_id"), ("fact_deliveries", "delivery_id"),
         ("dim_depot", "depot_id"), ("dim_product", "product_id"))


def _source(table: str, suffix: str) -> str:
    # The depot dimension has one suffixed form: it is the same in every star but the broken one.
    return "depots_s" if table == "dim_depot" and suffix != "_broken" else table + suffix


def _tests_sql(kinds=("unique", "not_null", "relationships", "rows"), suffix: str = "") -> str:
    parts = []
    for table, key in _KEYS:
        frm = _source(table, suffix)
        if "unique" in kinds:
            parts.append(_test_sql("unique", table, key, f"""
                select count(*) from (select {key} from {frm} where {key} is not null group by 1 having count(*) > 1)"""))
        if "not_null" in kinds:
            parts.append(_test_sql("not_null", table, key, f"select count(*) from {frm} where {key} is null"))
    if "relationships" in kinds:
        for table, key, parent in (("fact_orders", "depot_id", "dim_depot"), ("fact_orders", "product_id", "dim_product"),
                                   ("fact_deliveries", "depot_id", "dim_depot")):
            parts.append(_test_sql("relationships", table, key, f"""
                select count(*) from {_source(table, suffix)} where {key} is not null
                and {key} not in (select {key} from {_source(parent, suffix)} where {key} is not null)"""))
    if "rows" in kinds:
        parts.append(_test_sql("rows", "fact_orders", "line_value",
                               f"select count(*) from fact_orders{suffix} where line_value <= 0"))
        parts.append(_test_sql("rows", "fact_deliveries", "transit_minutes, distance_km", f"""
            select count(*) from fact_deliveries{suffix} where transit_minutes < 0 or distance_km < 0"""))
    return f"""
select *, case when failures = 0 then 'PASS' else 'FAIL' end as status from ({' union all '.join(parts)})"""


def _published(r):
    """The star over silver tables that were judged once and written: many questions scan it."""
    return gold_plan.build_gold(silver_plan.settled_silver(typed(r)), r.products)


def _cube(r):
    """The cube of the published star: written once, it answers without its facts."""
    return settle(cube.build_cube(_published(r)), "cube")


def _kind(key: str, *kinds: str):
    # On the ungated star, where the tests have something to find.
    @query(key, _tests_sql(kinds, "_ungated"))
    def _(r):
        tests = [t for t in gold_plan.star_tests() if t.kind in kinds]
        return checks.run_tests(tests, ungated_gold(r))


_kind("test_unique", "unique")
_kind("test_not_null", "not_null")
_kind("test_relationships", "relationships")


@query("test_positive_line_value", "select * from fact_orders_ungated where line_value <= 0")
def _(r):
    return ungated_gold(r)["fact_orders"].filter(F.col("line_value") <= 0)


@query("test_valid_delivery_measures", "select * from fact_deliveries_ungated where transit_minutes < 0 or distance_km < 0")
def _(r):
    return ungated_gold(r)["fact_deliveries"].filter((F.col("transit_minutes") < 0) | (F.col("distance_km") < 0))


@query("run_tests", _tests_sql())
def _(r):
    return checks.run_tests(gold_plan.star_tests(), _published(r))


@query("test_summary", f"""
select status, count(*) as tests, cast(sum(failures) as bigint) as failures from ({_tests_sql()}) group by 1""")
def _(r):
    return checks.summary(checks.run_tests(gold_plan.star_tests(), _published(r)))


@query("sabotage_drill", f"""
with sabotaged_lines as (select * replace (case when order_id % 7 = 3 then -1 else depot_id end as depot_id) from lines_s),
fact_orders_hurt as (
  select order_line_id, depot_id, product_id, cast(quantity * unit_price as decimal(12,2)) as line_value from sabotaged_lines),
fact_deliveries_hurt as (select * from fact_deliveries),
dim_product_hurt as (select * from dim_product)
select 'sabotaged' as phase, * from ({_tests_sql(suffix='_hurt')}) union all
select 'restored', * from ({_tests_sql()})""")
def _(r):
    g = _published(r)
    hurt = drills.orphan_keys(g["fact_orders"], "depot_id", F.col("order_id") % 7 == 3, [-1], F.lit(0))
    tests = gold_plan.star_tests()
    return drills.sabotage(tests, g, {**g, "fact_orders": hurt})


@query("sabotage_every_test", f"""
with lines_twice as (select *, unnest(case when order_id % 53 = 1 then [0, 1] else [0] end) as copy_no from fact_orders),
fact_orders_broken as (
  select case when order_id % 59 = 2 then null else order_line_id end as order_line_id,
         case when order_id % 47 = 3 then -1 else depot_id end as depot_id,
         case when order_id % 61 = 4 then -1 else product_id end as product_id,
         case when order_id % 67 = 5 then -line_value else line_value end as line_value from lines_twice),
trips_twice as (select *, unnest(case when delivery_id % 53 = 1 then [0, 1] else [0] end) as copy_no from fact_deliveries),
fact_deliveries_broken as (
  select case when delivery_id % 59 = 2 then null else delivery_id end as delivery_id,
         case when delivery_id % 61 = 4 then -1 else depot_id end as depot_id, transit_minutes,
         case when delivery_id % 67 = 5 then -distance_km else distance_km end as distance_km from trips_twice),
dim_depot_broken as (
  select case when depot_id % 19 = 2 then null else depot_id end as depot_id
  from (select *, unnest(case when depot_id % 17 = 1 then [0, 1] else [0] end) as copy_no from depots_s)),
dim_product_broken as (
  select case when product_id % 29 = 2 then null else product_id end as product_id
  from (select *, unnest(case when product_id % 23 = 1 then [0, 1] else [0] end) as copy_no from dim_product))
select 'sabotaged' as phase, * from ({_tests_sql(suffix='_broken')}) union all
select 'restored', * from ({_tests_sql()})""")
def _(r):
    """Each of the thirteen tests turns red on the broken star and green on the sound one."""
    g = {name: df for name, df in _published(r).items()}
    return drills.sabotage(gold_plan.star_tests(), g, drills.break_star(g))


# --- measures ------------------------------------------------------------------------------

_MEASURE_KEYS = {
    "m_total_revenue": "Total Revenue",
    "m_total_orders": "Total Orders",
    "m_order_lines": "Order Lines",
    "m_avg_line_value": "Avg Line Value",
    "m_active_products": "Active Products",
    "m_total_deliveries": "Total Deliveries",
    "m_delivery_success_rate": "Delivery Success Rate",
    "m_cold_chain_breaches": "Cold Chain Breaches",
}


def _measure_query(key: str, name: str):
    @query(key, f"select measure, value from measures where measure = '{name}'")
    def _(r):
        return measures.evaluate(gold(r), name)


for _key, _name in _MEASURE_KEYS.items():
    _measure_query(_key, _name)


@query("all_measures", "select measure, value from measures")
def _(r):
    return measures.all_measures(_published(r))


def _from_text(r):
    """The four tables as CSV files of text, read back as such and typed."""
    text = {name: read_raw(r.spark, export_csv(as_text(df), work_folder(r.spark, f"csv-{name}")), df.columns)
            for name, df in r.all.items()}
    return silver_plan.type_all(text), text


@query("csv_rule_results", """
select rule, "table", action, violations, cast(rows_rejected as bigint) as rows_rejected,
       case when violations = 0 then 'PASS' else action end as status
from rule_counts""")
def _(r):
    typed_text, _ = _from_text(r)
    return silver_plan.judged_results(typed_text).drop("description", "halts")


@query("csv_to_measures", """
select measure, case when measure = 'Avg Line Value' then round(value, 6) else value end as value from measures""")
def _(r):
    typed_text, text = _from_text(r)
    star = gold_plan.build_gold(silver_plan.settled_silver(typed_text), silver_plan.type_products(text["products"]))
    rounded = F.when(F.col("measure") == "Avg Line Value", F.round("value", 6)).otherwise(F.col("value"))
    return measures.all_measures(star).withColumn("value", rounded)


_MEMBERS_OF = (("Total Revenue", "region"), ("Total Orders", "category"), ("Cold Chain Breaches", "status"),
               ("Active Products", "city"))
_MEMBERS_SQL = """
select 'Total Revenue' as measure, region as member, cast(sum(line_value) as double) as value
from fact_orders left join depots_s using (depot_id) group by 2 union all
select 'Total Orders', category, cast(count(distinct order_id) as double)
from fact_orders left join dim_product using (product_id) group by 2 union all
select 'Cold Chain Breaches', status, cast(count(*) filter (where temperature_breach_flag) as double)
from fact_deliveries group by 2 union all
select 'Active Products', city, v from (select distinct city from depots_s),
  (select value as v from measures where measure = 'Active Products')"""


@query("measure_by_dim", _MEMBERS_SQL)
def _(r):
    g = _published(r)
    parts = [measures.measure_by(g, m, d).withColumn("measure", F.lit(m)) for m, d in _MEMBERS_OF]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("members_from_cube", _MEMBERS_SQL)
def _(r):
    return cube.answers_by(_cube(r), _MEMBERS_OF).drop("dimension")


def _asked() -> list[tuple[str, dict | None, str, str]]:
    """(measure, filter, mode, SQL of the value): reachable, unreachable and status filters."""
    europe, chilled, failed = ("region", "EUROPE"), ("category", "Brand#11"), ("status", "FAILED")
    in_europe = "depot_id in (select depot_id from depots_s where region = 'EUROPE')"
    of_brand = "product_id in (select product_id from dim_product where category = 'Brand#11')"

    def flt(pair):
        return {"dimension": pair[0], "value": pair[1]}

    return [
        ("Total Revenue", None, "override", "select cast(sum(line_value) as double) from fact_orders"),
        ("Total Revenue", flt(europe), "override",
         f"select cast(coalesce(sum(line_value), 0) as double) from fact_orders where {in_europe}"),
        ("Avg Line Value", flt(chilled), "override",
         f"select {ratio('sum(line_value)', 'count(*)')} from fact_orders where {of_brand}"),
        ("Active Products", flt(europe), "override", "select value from measures where measure = 'Active Products'"),
        ("Active Products", flt(chilled), "override",
         "select cast(count(distinct product_id) as double) from dim_product where is_active and category = 'Brand#11'"),
        ("Total Deliveries", flt(chilled), "override", "select cast(count(*) as double) from fact_deliveries"),
        ("Total Deliveries", flt(europe), "override",
         f"select cast(count(*) as double) from fact_deliveries where {in_europe}"),
        ("Cold Chain Breaches", flt(failed), "override",
         "select cast(count(*) as double) from fact_deliveries where status = 'FAILED' and temperature_breach_flag"),
        ("Delivery Success Rate", flt(failed), "override",
         f"""select {ratio("count(*) filter (where status = 'DELIVERED')", "count(*) filter (where status = 'FAILED')")}
             from fact_deliveries"""),
        ("Delivery Success Rate", flt(failed), "intersect", "select 0.0::double"),
    ]


_ASKED_SQL = " union all ".join(f"""
select '{m}' as measure, ({sql}) as value, 'gold_star' as grounded_from,
       '{(f or {}).get("dimension", "")}' as dimension, '{(f or {}).get("value", "")}' as member, '{mode}' as mode"""
    for m, f, mode, sql in _asked())


@query("query_metric", _ASKED_SQL)
def _(r):
    g = _published(r)
    out = None
    for m, f, mode, _sql in _asked():
        named = f or {}
        part = measures.query_metric(g, m, f, filter_mode=mode).withColumns({
            "dimension": F.lit(named.get("dimension", "")), "member": F.lit(named.get("value", "")), "mode": F.lit(mode)})
        out = part if out is None else out.unionByName(part)
    return out


@query("metric_from_cube", _ASKED_SQL)
def _(r):
    asked = [cube.Question(m, (f or {}).get("dimension"), (f or {}).get("value"), mode) for m, f, mode, _sql in _asked()]
    return cube.answers(_cube(r), asked).drop("place").fillna("", ["dimension", "member"])


_CUBE_SQL = {
    "fact_orders": ("fact_orders left join depots_s using (depot_id) left join dim_product using (product_id)",
                    "coalesce(sum(line_value), 0)", "0", "0", "count(distinct order_id)",
                    ("region", "city", "category", "temperature_zone")),
    "fact_deliveries": ("fact_deliveries left join depots_s using (depot_id)", "0", "count(*) filter (where status = 'DELIVERED')",
                        "count(*) filter (where temperature_breach_flag)", "0", ("region", "city", "status")),
    "dim_product": ("dim_product", "0", "0", "0", "count(distinct product_id) filter (where is_active)",
                    ("category", "temperature_zone")),
    "dim_depot": ("depots_s", "0", "0", "0", "0", ("region", "city")),
}


@query("measure_cube", " union all ".join(f"""
select '{fact}' as fact, {dimension} as dimension, {member} as member, count(*) as n_rows, cast({value} as double) as line_value,
       cast({delivered} as bigint) as delivered, cast({breaches} as bigint) as breaches, cast({keys} as bigint) as n_keys
from {source} group by all"""
    for fact, (source, value, delivered, breaches, keys, dims) in _CUBE_SQL.items()
    for dimension, member in [("null::varchar", "null::varchar"), *[(f"'{d}'", d) for d in dims]]))
def _(r):
    """The cube after two loads: lines and deliveries from 1995 on come later, and only they are read for the merge."""
    g = {name: settle(df, f"star-{name}") for name, df in _published(r).items()}
    late = {"fact_orders": "ordered_at", "fact_deliveries": "dispatched_at"}
    later = {n: F.coalesce(F.col(c) >= F.lit("1995-01-01").cast("timestamp"), F.lit(False)) for n, c in late.items()}
    first = {n: df.filter(~later[n]) if n in later else df for n, df in g.items()}
    before = settle(cube.build_cube(first), "cube-before")
    new = cube.build_cube({n: df.filter(later[n]) if n in later else df for n, df in g.items()})
    after = settle(cube.merge([before, new.filter(F.col("fact").isin(list(late)))]), "cube")
    return after.groupBy("fact", "dimension", "member").agg(
        F.sum("n_rows").alias("n_rows"), F.coalesce(F.sum("line_value"), F.lit(0)).cast("double").alias("line_value"),
        *[F.sum(c).alias(c) for c in ("delivered", "breaches", "n_keys")])


@query("metric_audit", """
select 'Total Orders' as measure, null::varchar as dimension, null::varchar as filter_value, value
from measures where measure = 'Total Orders' union all
select 'Total Deliveries', 'status', 'FAILED', cast(count(*) as double) from fact_deliveries where status = 'FAILED'""")
def _(r):
    g, log = gold(r), work_folder(r.spark, "metric-audit")
    failed = {"dimension": "status", "value": "FAILED"}
    measures.audit(measures.query_metric(g, "Total Orders"), None, path=log)
    return measures.audit(measures.query_metric(g, "Total Deliveries", failed), failed, path=log).drop("asked_at")


_QUESTION_ROWS = ", ".join(f"('{q}', '{m}')" for q, m in measures.QUESTIONS.items())


@query("question_map", f"""
select upper(q) || '?' as question, q.measure, value
from (values {_QUESTION_ROWS}) q(q, measure) left join measures m on q.measure = m.measure""")
def _(r):
    asked = r.spark.createDataFrame([(q.upper() + "?",) for q in measures.QUESTIONS], "question string")
    return measures.answer_questions(asked, "question", gold(r))


# --- reports -------------------------------------------------------------------------------


@query("kpi_exec", f"""
select revenue, orders, order_lines, customers, {ratio('revenue', 'order_lines')} as avg_line_value, active_products,
       product_categories, withdrawn_products
from (select cast(sum(line_value) as decimal(22,2)) as revenue, count(distinct order_id) as orders,
             count(*) as order_lines, count(distinct customer_id) as customers from fact_orders),
     (select count(distinct product_id) filter (where is_active) as active_products,
             count(distinct category) as product_categories,
             count(*) filter (where not is_active) as withdrawn_products from dim_product)""")
def _(r):
    return reports.kpi_exec(gold(r))


@query("kpi_ops", f"""
select count(*) as deliveries, count(*) filter (where status = 'DELIVERED') as delivered,
       {pct("count(*) filter (where status = 'DELIVERED')", 'count(*)')} as delivered_pct,
       count(*) filter (where status = 'FAILED') as failed,
       {pct("count(*) filter (where status = 'FAILED')", 'count(*)')} as failed_pct,
       {ratio('sum(transit_minutes)', 'count(*)')} as avg_transit,
       count(*) filter (where temperature_breach_flag) as breaches,
       (select count(*) from deliveries_raw where temperature_breach_flag is null) as unknown_breaches
from fact_deliveries""")
def _(r):
    return reports.kpi_ops(gold(r)["fact_deliveries"], r.deliveries)


def _share_sql(attribute: str, dimension: str, key: str) -> str:
    return f"""
with totals as (
  select {attribute}, cast(sum(line_value) as decimal(22,2)) as revenue
  from fact_orders left join {dimension} using ({key}) group by 1)
select {attribute}, revenue, cast(revenue as double) / (select cast(sum(revenue) as double) from totals) as share
from totals"""


@query("revenue_by_region", _share_sql("region", "depots_s", "depot_id"))
def _(r):
    return reports.revenue_by_region(gold(r))


@query("revenue_by_category", _share_sql("category", "dim_product", "product_id"))
def _(r):
    return reports.revenue_by_category(gold(r))


@query("status_mix", """
select status, count(*) as deliveries, cast(count(*) as double) / (select cast(count(*) as double) from fact_deliveries) as share
from fact_deliveries group by 1""")
def _(r):
    return reports.status_mix(gold(r)["fact_deliveries"])


_COLUMNS_SQL = ", ".join(f"('{e.id}', '{e.column}')" for e in silver_plan.REGISTER)


@query("dq_page", f"""
select c.rule, "table", v."column", action, violations, case when violations = 0 then 'PASS' else action end as status,
       n as rows_in, cast(q as bigint) as rows_quarantined, {pct('q', 'n')} as quarantine_pct,
       case when t * 100.0 > n * 5.0 then 'HALT' else 'PASS' end as gate
from rule_counts c join (values {_COLUMNS_SQL}) v(rule, "column") on c.rule = v.rule, total_in,
     (select sum(rows_rejected) as q, sum(violations) filter (where action = 'FAIL') as t from rule_counts)""")
def _(r):
    results = silver_plan.judged_results(typed(r))
    totals = gate.gate_totals(results, gate.rows_in(list(r.all.values())))
    return reports.quality_page(results, totals)
