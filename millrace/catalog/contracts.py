"""Row contracts, keys, references, and the gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import pct, query, silver, tagged, typed
from millrace.operators import gate, keys, references, rules
from millrace.operators.tagging import rejected, survivors, tag
from millrace.plans import silver as plan
from millrace.plans.reports import register_with_counts

# --- single rules, each on rows nothing else has judged ------------------------------------


def _only(rule_id: str, every: list) -> list:
    return [rule for rule in every if rule.id == rule_id]


def _rejected_by(df, table: str, rule_id: str, every: list, lookups=()):
    return rejected(tag(df, table, _only(rule_id, every), lookups))


@query("row_rule", """
select delivery_id, 'R14' as _dq_rule, distance_km from deliveries_raw where distance_km < 0""")
def _(r):
    rule = rules.RowRule("R14", "distance_km", "negative", bad=F.col("distance_km") < 0)
    return rejected(tag(r.deliveries, "deliveries", [rule])).select("delivery_id", "_dq_rule", "distance_km")


@query("rule_cost_gt_price", "select product_id, unit_cost, unit_price from products_raw where unit_cost > unit_price")
def _(r):
    bad = _rejected_by(r.products, "products", "R2", plan.product_rules())
    return bad.select("product_id", "unit_cost", "unit_price")


@query("rule_null_warn", """
select order_line_id, quantity, requested_delivery_date is null as _dq_r5 from lines_raw""")
def _(r):
    judged = tag(r.order_lines, "orders", _only("R5", plan.order_rules(r.depots)))
    return survivors(judged).select("order_line_id", "quantity", "_dq_r5")


@query("rule_non_positive", "select order_line_id, quantity from lines_raw where quantity <= 0")
def _(r):
    bad = _rejected_by(r.order_lines, "orders", "R6", plan.order_rules(r.depots))
    return bad.select("order_line_id", "quantity")


def _master(r):
    products = references.one_per_key(r.products, "product_id")
    return rules.Lookup("product_id", products, "product_id", {"unit_price": plan.MASTER_PRICE})


@query("rule_price_drift", """
select order_line_id, l.unit_price, p.unit_price as expected
from lines_raw l join products_one p on l.product_id = p.product_id
where l.unit_price <> p.unit_price""")
def _(r):
    bad = _rejected_by(r.order_lines, "orders", "R8", plan.order_rules(r.depots), [_master(r)])
    return bad.select("order_line_id", "unit_price", F.col(f"_dq_expected{plan.MASTER_PRICE}").alias("expected"))


@query("rule_missing_parent_warn", """
select order_line_id, quantity, product_id not in (select product_id from products_s) as _dq_r17 from lines_raw""")
def _(r):
    master = rules.Lookup("product_id", silver(r)["products"], "product_id", {"unit_price": plan.MASTER_PRICE})
    judged = tag(r.order_lines, "orders", _only("R17", plan.order_rules(r.depots)), [master])
    return survivors(judged).select("order_line_id", "quantity", "_dq_r17")


def _delivery_rule(key: str, rule_id: str, condition: str):
    @query(key, f"select delivery_id, dispatched_at, delivered_at, distance_km from deliveries_raw where {condition}")
    def _(r):
        bad = _rejected_by(r.deliveries, "deliveries", rule_id, plan.delivery_rules(r.order_lines))
        return bad.select("delivery_id", "dispatched_at", "delivered_at", "distance_km")


_delivery_rule("rule_null_fail", "R12", "temperature_breach_flag is null")
_delivery_rule("rule_time_order", "R13", "delivered_at < dispatched_at")
_delivery_rule("rule_negative", "R14", "distance_km < 0")


@query("rule_fk_depot", "select order_line_id, depot_id from lines_raw anti join depots_raw using (depot_id)")
def _(r):
    bad = _rejected_by(r.order_lines, "orders", "R7", plan.order_rules(r.depots))
    return bad.select("order_line_id", "depot_id")


@query("rule_fk_order", "select delivery_id, order_id from deliveries_raw anti join lines_s using (order_id)")
def _(r):
    bad = _rejected_by(r.deliveries, "deliveries", "R10", plan.delivery_rules(silver(r)["orders"]))
    return bad.select("delivery_id", "order_id")


@query("rule_check", """
select 'shipped before ordered' as "check", count(*) as violations,
       case when count(*) = 0 then 'PASS' else 'FAIL' end as status
from lineitem join orders on l_orderkey = o_orderkey where l_shipdate < o_orderdate""")
def _(r):
    joined = r.source("lineitem").select("l_orderkey", "l_shipdate").join(
        r.source("orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rules.check(joined, F.col("l_shipdate") < F.col("o_orderdate"), "shipped before ordered")


def _too_early(key: str, at: str):
    @query(key, f"""
with firsts as (select order_id, min(order_datetime) as first_at from lines_raw group by 1)
select delivery_id, order_id, d.{at}, first_at, d.{at} < first_at as too_early
from deliveries_raw d join firsts using (order_id)""")
    def _(r):
        return references.precedes_first(r.deliveries, "order_id", at, r.order_lines, "order_datetime").select(
            "delivery_id", "order_id", at, "first_at", "too_early")


_too_early("rule_dispatch_before_order", "dispatched_at")
_too_early("rule_deliver_before_order", "delivered_at")


@query("conformance_gap", """
select 'status' as "column", count(*) filter (where status <> upper(trim(status))) as non_conforming,
       count(distinct status) as raw_values, count(distinct upper(trim(status))) as conformed_values
from deliveries_raw""")
def _(r):
    return rules.conformance_gap(r.deliveries, "status")


def _register_sql(where: str) -> str:
    values = ", ".join(
        "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in
                        (e.id, e.table, e.column, e.defect, e.action, e.rationale)) + ")"
        for e in plan.REGISTER
    )
    return f"""
select v.*, c.violations, cast(c.rows_rejected as bigint) as rows_rejected,
       case when c.violations = 0 then 'PASS' else c.action end as status
from (values {values}) v(rule, "table", "column", defect, action, rationale)
left join rule_counts c on v.rule = c.rule {where}"""


@query("rule_catalogue", _register_sql(""))
def _(r):
    return register_with_counts(plan.judged_results(typed(r)))


@query("document_rule", """
select 'R9' as rule, 'customer_id' as "column", 'DOCUMENT' as action, count(distinct customer_id) as members from lines_raw
union all
select 'R15', 'vehicle_id', 'DOCUMENT', count(distinct vehicle_id) from deliveries_raw""")
def _(r):
    # The boundary rules check nothing; beside each stands how many members the key has.
    members = {"R9": r.order_lines.agg(F.count_distinct("customer_id")),
               "R15": r.deliveries.agg(F.count_distinct("vehicle_id"))}
    noted = rules.register_frame(r.spark, plan.REGISTER).filter(F.col("action") == rules.DOCUMENT)
    count = F.when(F.col("rule") == "R9", members["R9"].scalar()).otherwise(members["R15"].scalar())
    return noted.select("rule", "column", "action", count.alias("members"))


# --- keys ----------------------------------------------------------------------------------


@query("drop_identical", "select * from lines_d")
def _(r):
    return keys.drop_identical(r.order_lines)


@query("unique_rule", """
select order_line_id, quantity from lines_d semi join r4_keys using (order_line_id)""")
def _(r):
    judged = tag(r.order_lines, "orders", _only("R4", plan.order_rules(r.depots)), drop_identical=True)
    return rejected(judged).select("order_line_id", "quantity")


@query("key_integrity", """
select "table", "key", n_rows, distinct_keys, n_rows - distinct_keys as surplus_rows, n_rows - different as identical_rows,
       case when n_rows = distinct_keys then 'OK' else 'DUP' end as status
from (
  select 'products' as "table", 'product_id' as "key", count(*) as n_rows, count(distinct product_id) as distinct_keys,
         (select count(*) from (select distinct * from products_raw)) as different from products_raw union all
  select 'depots', 'depot_id', count(*), count(distinct depot_id),
         (select count(*) from (select distinct * from depots_raw)) from depots_raw union all
  select 'orders', 'order_line_id', count(*), count(distinct order_line_id),
         (select count(*) from (select distinct * from lines_raw)) from lines_raw union all
  select 'deliveries', 'delivery_id', count(*), count(distinct delivery_id),
         (select count(*) from (select distinct * from deliveries_raw)) from deliveries_raw)""")
def _(r):
    named = {"products": "product_id", "depots": "depot_id", "orders": "order_line_id", "deliveries": "delivery_id"}
    parts = [keys.key_integrity(r.all[table], key, table) for table, key in named.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("duplicate_kind", """
select case when versions = 1 then 'IDENTICAL' else 'CONFLICT' end as kind, count(*) as n_keys,
       cast(sum(n) as bigint) as n_rows
from (select order_line_id, count(*) as n,
             count(distinct (order_line_id, quantity, unit_price, depot_id, product_id)) as versions
      from lines_raw group by 1 having count(*) > 1)
group by 1""")
def _(r):
    return keys.duplicate_kind(r.order_lines, "order_line_id")


_LINE_KEY = "l_orderkey, l_linenumber"


@query("dup_key_semi", f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
where ({_LINE_KEY}) in (select ({_LINE_KEY}) from lineitem group by {_LINE_KEY} having count(*) > 1)""")
def _(r):
    return _line_keys(r)[1]


@query("dup_key_anti", f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
where ({_LINE_KEY}) in (select ({_LINE_KEY}) from lineitem group by {_LINE_KEY} having count(*) = 1)""")
def _(r):
    return _line_keys(r)[0]


def _line_keys(r):
    items = r.source("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return keys.reject_repeated(items, ["l_orderkey", "l_linenumber"])


# --- joins ---------------------------------------------------------------------------------


@query("lookup_left", """
select order_line_id, l.unit_price, p.unit_price as master_price
from lines_raw l left join products_s p on l.product_id = p.product_id""")
def _(r):
    found = references.lookup(r.order_lines, "product_id", silver(r)["products"], "product_id",
                              {"unit_price": "master_price"})
    return found.select("order_line_id", "unit_price", "master_price")


@query("fk_anti", "select order_line_id, product_id from lines_raw anti join products_s using (product_id)")
def _(r):
    rows = r.order_lines.select("order_line_id", "product_id")
    return references.orphans(rows, "product_id", silver(r)["products"], "product_id")


@query("fk_semi", "select order_line_id, product_id from lines_raw semi join products_s using (product_id)")
def _(r):
    rows = r.order_lines.select("order_line_id", "product_id")
    return references.with_parent(rows, "product_id", silver(r)["products"], "product_id")


@query("inner_min_time", """
select delivery_id, first_at from deliveries_raw
join (select order_id, min(order_datetime) as first_at from lines_raw group by 1) using (order_id)""")
def _(r):
    joined = references.precedes_first(r.deliveries, "order_id", "dispatched_at", r.order_lines, "order_datetime")
    return joined.select("delivery_id", "first_at")


@query("membership", """
select depot_id, count(*) as n_rows from lines_raw
where depot_id is not null and depot_id not in (select depot_id from depots_raw) group by 1""")
def _(r):
    loose = references.orphans(r.order_lines, "depot_id", r.depots, "depot_id", null_is_orphan=False)
    return loose.groupBy("depot_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("fk_rule", """
select order_line_id, depot_id, product_id, exists (select 1 from depots_raw d where d.depot_id = l.depot_id) as has_depot
from lines_raw l""")
def _(r):
    rows = r.order_lines.select("order_line_id", "depot_id", "product_id")
    return references.mark_parent(rows, "depot_id", r.depots, "depot_id", "has_depot")


def _fk_sql(label: str, child: str, column: str, parent: str) -> str:
    return f"""
select '{label}' as "check", count(*) as orphans, {pct('count(*)', f'(select count({column}) from {child})')} as orphan_pct,
       count(distinct {column}) as distinct_bad_keys,
       (select coalesce(string_agg(cast({column} as varchar), ',' order by {column}), '') from (
          select distinct {column} from {child} where {column} not in (select {column} from {parent})
          order by {column} limit 10)) as first_bad_keys,
       case when count(*) = 0 then 'PASS' else 'FAIL' end as status
from {child} where {column} not in (select {column} from {parent})"""


_FKS = (
    ("orders to products", "lines_raw", "product_id", "products_s"),
    ("deliveries to orders", "deliveries_raw", "order_id", "lines_s"),
    ("orders to depots", "lines_raw", "depot_id", "depots_raw"),
    ("deliveries to depots", "deliveries_raw", "depot_id", "depots_raw"),
)


@query("fk_report", " union all ".join(_fk_sql(*fk) for fk in _FKS))
def _(r):
    kept = silver(r)
    frames = {"lines_raw": r.order_lines, "deliveries_raw": r.deliveries, "depots_raw": r.depots,
              "products_s": kept["products"], "lines_s": kept["orders"]}
    parts = [references.fk_report(frames[child], column, frames[parent], column, label)
             for label, child, column, parent in _FKS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- gate ----------------------------------------------------------------------------------


@query("rule_results", """
select rule, "table", action, violations, cast(rows_rejected as bigint) as rows_rejected,
       case when violations = 0 then 'PASS' else action end as status
from rule_counts""")
def _(r):
    return plan.judged_results(typed(r)).drop("description", "halts")


def _gate_sql(limit: float) -> str:
    return f"""
select cast(v as bigint) as fail_violations, cast(q as bigint) as rows_quarantined, n as rows_in,
       {pct('v', 'n')} as violation_pct, {pct('q', 'n')} as quarantine_pct,
       cast({limit} as double) as threshold_pct, case when v * 100.0 > n * {limit} then 'HALT' else 'PASS' end as status
from (select sum(violations) filter (where action = 'FAIL') as v, sum(rows_rejected) as q from rule_counts), total_in"""


@query("gate", f"{_gate_sql(5.0)} union all {_gate_sql(2.5)}")
def _(r):
    results, total = plan.judged_results(typed(r)), gate.rows_in(list(r.all.values()))
    return gate.gate_totals(results, total, 5.0, 2.5)


@query("gate_totals", f"""
select cast(sum(violations) filter (where action = 'FAIL') as bigint) as fail_violations,
       cast(sum(rows_rejected) as bigint) as rows_quarantined from rule_counts""")
def _(r):
    total = gate.rows_in(list(r.all.values()))
    return gate.gate_totals(plan.judged_results(typed(r)), total).select("fail_violations", "rows_quarantined")


@query("quarantine", "select _dq_table, _dq_rule, row_key from rejected_all")
def _(r):
    t = tagged(r)
    held = gate.quarantine([t[n] for n in plan.GATED])
    key = F.coalesce("order_line_id", F.col("delivery_id").cast("string"), F.col("product_id").cast("string"))
    return held.select("_dq_table", "_dq_rule", key.alias("row_key"))


@query("quarantine_triage", "select _dq_table, _dq_rule, count(*) as n_rows from rejected_all group by all")
def _(r):
    t = tagged(r)
    return gate.triage(gate.quarantine([t[n] for n in plan.GATED])).drop("_dq_reason")


@query("silver_survivors", "select * from lines_s")
def _(r):
    return silver(r)["orders"]


@query("silver_deliveries", "select * from deliveries_s")
def _(r):
    return silver(r)["deliveries"]


@query("cascade_report", """
select case when s.product_id is null then 'CASCADE' else 'GENUINE' end as cause, count(*) as n_lines
from lines_raw l join products_one p on l.product_id = p.product_id
left join products_s s on l.product_id = s.product_id
where l.unit_price <> p.unit_price group by 1""")
def _(r):
    return plan.cascade_report(r.order_lines, r.products, silver(r)["products"])


@query("escalation_list", """
select product_id, count(*) as n_lines, min(unit_price) as min_price, max(unit_price) as max_price,
       max(master_price) as master_price from r8_bad group by 1""")
def _(r):
    return plan.escalation_list(rejected(tagged(r)["orders"]))
