"""Monitoring, grounding checks and defect drills."""

from __future__ import annotations

import datetime as dt
from contextlib import suppress

from pyspark.sql import functions as F

from millrace.catalog.base import gold, query, silver, tagged, typed, ungated_gold
from millrace.functions.figures import FIGURE
from millrace.operators import drills, gate, history, references
from millrace.plans import explain, measures, monitor, runs
from millrace.plans import silver as silver_plan
from millrace.session import work_folder
from millrace.sources.retail import GHOST_OFFSET, STRAY_STATUS
from millrace.sources.snapshots import Snapshot, SnapshotStore
from millrace.sources.tables import settle

# --- monitoring ----------------------------------------------------------------------------

_DAY = "order_datetime"


def _loads(r) -> Snapshot:
    """The store after four loads of the tables, dealt by order: the third is halted, the second comes twice.

    Built once per folder and session; the queries read its log and its quarantine.
    """
    key = (r.spark.sparkContext.applicationId, r.folder)
    store = SnapshotStore(r.spark, _STORES.setdefault(key, work_folder(r.spark, "loads")))
    if (last := store.latest()) is not None and last.version >= len(_MINUTES):
        return last
    every = typed(r)
    for k in (*range(len(_MINUTES)), 1):
        own = F.col("order_id") % len(_MINUTES) == k
        orders = every["orders"].filter(own)
        if k == 2:  # lines of a depot that nobody knows
            orders = drills.orphan_keys(orders, "depot_id", F.col("order_id") % 32 == 2, [-301], F.lit(0))
        start = dt.datetime(2026, 1, 5 + k, 2, tzinfo=dt.timezone.utc)
        run = runs.Run(f"load-{k}", start.date(), iter((start, start + dt.timedelta(minutes=_MINUTES[k]))).__next__)
        given = {**every, "orders": orders, "deliveries": every["deliveries"].filter(own)}
        with suppress(gate.ContractViolation):
            silver_plan.publish_silver(given, "loads_", location=store.root, run=run, append=("orders", "deliveries"))
    return store.latest()


_MINUTES = (18, 24, 41, 22)  # how long each load takes, by its own clock
_STORES: dict[tuple[str, str], str] = {}

_LOG = """
with loose as (
  select order_id, case when order_id % 32 = 2 then -301 else depot_id end as depot_id from lines_2
  where order_id % 32 = 2 or depot_id not in (select depot_id from depots_raw)),
hit("table", rule, order_id) as (
  select 'orders', 'R4', order_id from r4_bad union all
  select 'orders', 'R6', order_id from r6_bad union all
  select 'orders', 'R7', order_id from loose union all
  select 'orders', 'R8', order_id from r8_bad where order_id % 32 <> 2 union all
  select 'deliveries', 'R10', order_id from deliveries_t where order_id % 32 = 2 or order_id not in (select order_id from lines_s) union all
  select 'deliveries', 'R12', order_id from r12_bad where order_id % 32 <> 2 union all
  select 'deliveries', 'R13', order_id from r13_bad where order_id % 32 <> 2 union all
  select 'deliveries', 'R14', order_id from r14_bad where order_id % 32 <> 2),
k as (select unnest(range(0, 4)) as k),
read_rows as (
  select order_id % 4 as k, 'orders' as "table", count(*) as rows_in from lines_raw group by 1 union all
  select order_id % 4, 'deliveries', count(*) from deliveries_raw group by 1 union all
  select k, 'products', (select count(*) from products_raw) from k),
rejected as (
  select order_id % 4 as k, "table", count(*) as violations from hit group by all union all
  select k, 'products', (select count(*) from r1_bad) + (select count(*) from r2_bad) from k),
rates as (
  select 'load-' || k as run_id, date '2026-01-05' + cast(k as integer) as run_date, "table", rows_in,
         coalesce(violations, 0) as violations,
         cast(coalesce(violations, 0) as double) * cast(100 as double) / cast(rows_in as double) as rate_pct
  from read_rows left join rejected using (k, "table"))"""


def _rates(r):
    return monitor.quarantine_rate(runs.loads(_loads(r).table(runs.RUN_LOG)))


@query("quarantine_rate_by_run", f"{_LOG} select * from rates")
def _(r):
    return _rates(r)


@query("drift_hard", f"{_LOG} select * from rates where rate_pct > 5.0")
def _(r):
    return monitor.drift_hard(_rates(r))


@query("drift_soft", f"""{_LOG}
select run_id, run_date, "table", rows_in, violations, rate_pct, cast(mean_pct as decimal(18,4)) as mean_pct from (
  select *, avg(rate_pct) over (partition by "table" order by run_date
                                range between interval 7 days preceding and interval 1 day preceding) as mean_pct
  from rates)
where rate_pct > mean_pct + 2.0""")
def _(r):
    return monitor.drift_soft(_rates(r)).withColumn("mean_pct", F.col("mean_pct").cast("decimal(18,4)"))


@query("orphan_increase", f"""{_LOG},
firsts as (select k, count(*) as new_bad_keys from (select depot_id, min(order_id % 4) as k from loose group by 1) group by 1),
counted as (select order_id % 4 as k, count(*) as orphans from loose group by 1),
per_run as (select k, coalesce(orphans, 0) as orphans, coalesce(new_bad_keys, 0) as new_bad_keys
            from k left join counted using (k) left join firsts using (k))
select 'R7' as rule, 'load-' || k as run_id, date '2026-01-05' + cast(k as integer) as run_date, orphans, new_bad_keys,
       coalesce(lag(orphans) over (order by k), 0) as previous,
       orphans - coalesce(lag(orphans) over (order by k), 0) as increase
from per_run""")
def _(r):
    state = _loads(r)
    return monitor.orphan_increase_by_run(
        state.table(runs.RUN_LOG), state.table(runs.QUARANTINE, with_run=True), "depot_id", "R7")


@query("refresh_latency", """
select 'load-' || k as run_id, timestamp '2026-01-05 02:00:00' + to_days(k) as started_at,
       timestamp '2026-01-05 02:00:00' + to_days(k) + to_minutes(m) as finished_at, cast(m as bigint) as minutes,
       case when m > 30 then 'WARN' else 'PASS' end as status
from (values (0, 18), (1, 24), (2, 41), (3, 22)) runs(k, m) where (select count(*) from lines_raw) >= 0""")
def _(r):
    return monitor.refresh_latency(runs.durations(_loads(r).table(runs.RUN_LOG)))


@query("load_status", f"""{_LOG},
ended as (
  select run_id, run_date, cast(sum(rows_in) as bigint) as rows_in, cast(sum(violations) as bigint) as rows_rejected,
         case when run_id = 'load-2' then 'HALT' else 'PASS' end as status
  from rates group by all),
kept as (select order_id % 4 as k, count(*) as n from lines_s where order_id % 4 <> 2 group by 1)
select ended.*, coalesce(n, 0) as silver_orders from ended left join kept on run_id = 'load-' || k""")
def _(r):
    """Every load once, also the repeated one, and the order lines that it put into silver; the halted one put none."""
    state = _loads(r)
    log = runs.ended(state.table(runs.RUN_LOG))
    per_run = runs.loads(log).groupBy("run_id", "run_date").agg(
        F.sum("rows_in").alias("rows_in"), F.sum("violations").alias("rows_rejected"))
    status = log.groupBy("run_id").agg(F.max("status").alias("status"))
    kept = state.table("orders", with_run=True).groupBy(F.col("_run").alias("run_id")).agg(F.count(F.lit(1)).alias("n"))
    joined = per_run.join(status, "run_id").join(kept, "run_id", "left")
    return joined.withColumn("silver_orders", F.coalesce("n", F.lit(0))).drop("n")


@query("load_log_since", f"""{_LOG}
select run_id, "table", rows_in from rates where run_id in ('load-2', 'load-3')""")
def _(r):
    """What a reader that has seen the second version still has to read: the parts that later versions added."""
    log = _loads(r).table(runs.RUN_LOG, since=2)
    return runs.loads(log).select("run_id", "table", "rows_in")


_DAILY = """
with bad as (
  select order_datetime from r4_bad union all select order_datetime from r6_bad union all
  select order_datetime from r7_bad union all select order_datetime from r8_bad),
bad_days as (select cast(order_datetime as date) as run_date, count(*) as violations from bad group by 1),
read_days as (select cast(order_datetime as date) as run_date, count(*) as rows_in from lines_raw group by 1)"""


@query("backfill_rates", f"""{_DAILY}
select 'orders' as "table", cast(run_date as varchar) as run_id, run_date, rows_in, coalesce(violations, 0) as violations,
       cast(coalesce(violations, 0) as double) * cast(100 as double) / cast(rows_in as double) as rate_pct
from read_days left join bad_days using (run_date)""")
def _(r):
    log = runs.backfill(r.order_lines, tagged(r)["orders"], F.to_date(_DAY))
    return monitor.quarantine_rate(runs.loads(log))


@query("orphan_increase_by_day", """
with loose as (
  select cast(order_datetime as date) as run_date, depot_id, count(*) as n
  from lines_raw anti join depots_raw using (depot_id) group by 1, 2),
firsts as (select run_date, count(*) as new_bad_keys from (
  select depot_id, min(run_date) as run_date from loose group by 1) group by 1),
counted as (select run_date, cast(sum(n) as bigint) as n from loose group by 1),
daily as (select run_date, coalesce(n, 0) as orphans
          from (select distinct cast(order_datetime as date) as run_date from lines_raw) left join counted using (run_date))
select 'R7' as rule, run_date, orphans, coalesce(new_bad_keys, 0) as new_bad_keys,
       coalesce(lag(orphans) over (order by run_date), 0) as previous,
       orphans - coalesce(lag(orphans) over (order by run_date), 0) as increase
from daily left join firsts using (run_date)""")
def _(r):
    loose = references.orphans(r.order_lines, "depot_id", r.depots, "depot_id")
    return monitor.orphan_increase(r.order_lines, loose, "depot_id", F.to_date(_DAY), "R7")


@query("breach_rate_alert", """
select month(dispatched_at) as member, count(*) as deliveries, count(*) filter (where temperature_breach_flag) as breaches,
       cast(count(*) filter (where temperature_breach_flag) as double) * 100.0::double / count(*) as breach_pct,
       limit_pct, cast(count(*) filter (where temperature_breach_flag) as double) * 100.0::double / count(*) > limit_pct as alert
from fact_deliveries, (values (4.0::double), (6.0::double)) l(limit_pct) group by 1, limit_pct""")
def _(r):
    by_month = F.month("dispatched_at").cast("bigint")
    return monitor.breach_alert(gold(r)["fact_deliveries"], by_month, 4.0, 6.0)


@query("dimension_change", """
with a as (select distinct product_id from products_raw),
b as (select distinct product_id from products_s)
select product_id as member, 'NEW' as change from b where product_id not in (select product_id from a) union all
select product_id, 'REMOVED' from a where product_id not in (select product_id from b)""")
def _(r):
    return references.membership_changes(r.products, silver(r)["products"], "product_id")


# --- history of members ----------------------------------------------------------------------

_MASTER = [dt.datetime(1995, 1, 1), dt.datetime(1997, 7, 1), dt.datetime(1999, 10, 1)]


def _product_history(r):
    """The products after three loads of their master: members come, change their price and go; one load comes twice."""
    store = SnapshotStore(r.spark, work_folder(r.spark, "master"))
    every = settle(silver(r)["products"], "master")
    key = F.col("product_id")
    raised = every.withColumn("unit_price", F.when(key % 7 == 3, F.col("unit_price") * F.expr("1.10"))
                              .otherwise(F.col("unit_price")).cast("decimal(10,2)"))
    loads = [every.filter(key % 10 != 1), raised, raised.filter(key % 13 != 5)]
    for k in (0, 1, 1, 2):
        state = silver_plan.load_master(store, loads[k], runs.Run(f"master-{k}"), _MASTER[k])
    return state.table(silver_plan.HISTORY)


_HISTORY = """
with moments(k, since) as (values (0, timestamp '1995-01-01'), (1, timestamp '1997-07-01'), (2, timestamp '1999-10-01')),
states as (
  select product_id, k, since, case when k > 0 and product_id % 7 = 3 then cast(unit_price * 1.10 as decimal(10,2)) else unit_price end as price
  from products_s, moments where not (k = 0 and product_id % 10 = 1) and not (k = 2 and product_id % 13 = 5)),
marked as (
  select *, case when k - 1 is not distinct from lag(k) over w and price = lag(price) over w then 0 else 1 end as starts
  from states window w as (partition by product_id order by k)),
spans as (select *, sum(starts) over (partition by product_id order by k) as span from marked),
history as (
  select product_id, any_value(price) as unit_price, min(s.since) as valid_from,
         (select min(m.since) from moments m where m.k > max(s.k)) as valid_to
  from spans s group by product_id, span)"""


@query("member_history", f"{_HISTORY} select * from history")
def _(r):
    return _product_history(r).select("product_id", "unit_price", "valid_from", "valid_to")


@query("member_changes", f"""{_HISTORY}
select product_id, valid_from as "at", case when exists (select 1 from history b where b.product_id = a.product_id and b.valid_to = a.valid_from)
       then 'CHANGED' else 'NEW' end as change from history a union all
select product_id, valid_to, 'REMOVED' from history a where valid_to is not null
  and not exists (select 1 from history b where b.product_id = a.product_id and b.valid_from = a.valid_to)""")
def _(r):
    return history.changes(_product_history(r), ["product_id"])


@query("members_at", f"""{_HISTORY}
select product_id, arg_max(unit_price, valid_from) as unit_price,
       arg_max(coalesce(valid_to > timestamp '2000-01-01', true), valid_from) as is_active
from history where valid_from <= timestamp '2000-01-01' group by 1""")
def _(r):
    known = history.members_at(_product_history(r), ["product_id"], dt.datetime(2000, 1, 1))
    return known.select("product_id", "unit_price", "is_active")


@query("price_drift_as_of", f"""{_HISTORY},
priced as (
  select l.*, h.unit_price as valid_price from lines_3 l left join history h on l.product_id = h.product_id
    and l.order_datetime >= h.valid_from and (h.valid_to is null or l.order_datetime < h.valid_to))
select 'R8' as rule, count(*) as violations from priced where valid_price is not null and unit_price <> valid_price union all
select 'R17', count(*) from priced where valid_price is null""")
def _(r):
    t = typed(r)
    judged = silver_plan.tag_orders_as_of(t["orders"], t["depots"], _product_history(r))
    return gate.rule_results([judged]).filter(F.col("rule").isin("R8", "R17")).select("rule", "violations")


# --- explanations --------------------------------------------------------------------------


@query("explain_context", """
select m.measure, m.value, u.value as baseline,
       m.measure || ' = ' || cast(cast(m.value as decimal(24,2)) as varchar) || ' for all orders; baseline '
         || cast(cast(u.value as decimal(24,2)) as varchar) as context
from measures m join measures_ungated u using (measure)""")
def _(r):
    return explain.explain_context(
        measures.all_measures(gold(r)), measures.all_measures(ungated_gold(r)), "all orders")


@query("grounding_check", f"""
with found as (
  select doc_id, n_chars, list_distinct(list_transform(
    regexp_extract_all(text, '{FIGURE}'), lambda x: replace(x, ',', ''))) as figures
  from documents),
loose as (
  select doc_id, len(figures) as n_figures,
         list_sort(list_filter(figures, lambda x: try_cast(x as double) <> n_chars and try_cast(x as double) <> doc_id)) as bad
  from found)
select doc_id, cast(n_figures as integer) as n_figures, coalesce(array_to_string(bad, ','), '') as ungrounded,
       case when len(bad) > 0 then 'FAIL' else 'PASS' end as status
from loose""")
def _(r):
    texts = r.source("documents").select("doc_id", "n_chars", "text")
    checked = explain.grounding_check(texts, "text", F.array("n_chars", "doc_id"))
    listed = F.array_join(F.sort_array("ungrounded"), ",")
    return checked.select("doc_id", "n_figures", listed.alias("ungrounded"), "status")


@query("derived_figures", rf"""
with texts as (
  select m.measure, kind, [cast(m.value as double), cast(u.value as double)] as given,
         m.measure || ' was ' || cast(cast(m.value + off as decimal(24,2)) as varchar) || ' against '
           || cast(cast(u.value as decimal(24,2)) as varchar) || ', a difference of '
           || cast(abs(cast(m.value as decimal(24,2)) - cast(u.value as decimal(24,2))) as varchar) || '.' as text
  from measures m join measures_ungated u using (measure), (values ('true', 0.0::double), ('altered', 1.75::double)) k(kind, off)),
found as (
  select *, unnest(list_distinct(list_transform(regexp_extract_all(text, '{FIGURE}'), lambda x: replace(x, ',', '')))) as figure from texts),
sized as (
  select *, cast(figure as double) as f, 0.5::double / pow(10.0::double, length(regexp_extract(figure, '\.([0-9]+)$', 1))) + 1e-9::double as reach
  from found),
pairs as (
  select measure, kind, figure, f, reach, given[i] as a, given[j] as b, i <> j as two
  from sized, (values (1), (2)) x(i), (values (1), (2)) y(j)),
told as (
  select measure, kind, figure,
         case when bool_or(abs(a - f) <= reach) then 'given' when bool_or(two and abs(a + b - f) <= reach) then 'sum'
              when bool_or(two and abs(abs(a - b) - f) <= reach) then 'difference'
              when bool_or(two and b <> 0 and abs(100.0::double * (a / b) - f) <= reach) then 'percent'
              when bool_or(two and b <> 0 and abs(a / b - f) <= reach) then 'ratio' else 'unknown' end as how
  from pairs group by all)
select measure, kind, string_agg(figure || ':' || how, ',' order by figure) as figures,
       case when bool_or(how = 'unknown') then 'FAIL' else 'PASS' end as status
from told group by all""")
def _(r):
    """True and altered sentences about the measures: every figure is traced to what was provided, or named."""
    context = settle(explain.explain_context(
        measures.all_measures(gold(r)), measures.all_measures(ungated_gold(r)), "all orders"), "context")
    told = [explain.explain_change(context, F.col("value") + off).withColumn("kind", F.lit(kind))
            for kind, off in (("true", 0.0), ("altered", 1.75))]
    judged = explain.derivation_check(told[0].unionByName(told[1]), "text", F.array("value", "baseline"))
    listed = F.array_join(F.sort_array(F.transform("figures", lambda x: F.concat_ws(":", x["figure"], x["how"]))), ",")
    return judged.select("measure", "kind", listed.alias("figures"), "status")


# --- drills --------------------------------------------------------------------------------


@query("inject_orphan_fk", """
select order_line_id, case when order_id % 133 = 17 then [-301, -302, -303][customer_id % 3 + 1] else depot_id end as depot_id
from lines_raw""")
def _(r):
    hurt = drills.orphan_keys(r.order_lines, "depot_id", F.col("order_id") % 133 == 17, [-301, -302, -303], F.col("customer_id"))
    return hurt.select("order_line_id", F.col("depot_id").cast("bigint").alias("depot_id"))


@query("inject_duplicates", """
select * from lines_raw union all select * from lines_raw where order_id % 176 = 29""")
def _(r):
    return drills.repeat_rows(r.order_lines, F.col("order_id") % 176 == 29)


@query("inject_non_positive", """
select order_line_id, case when order_id % 240 = 7 then [-3, 0, -8, -20][customer_id % 4 + 1] else quantity end as quantity
from lines_raw""")
def _(r):
    hurt = drills.non_positive(r.order_lines, "quantity", F.col("order_id") % 240 == 7, [-3, 0, -8, -20], F.col("customer_id"))
    return hurt.select("order_line_id", "quantity")


@query("inject_null", """
select delivery_id, case when delivery_id % 47 = 8 then null else temperature_breach_flag end as temperature_breach_flag
from deliveries_raw""")
def _(r):
    hurt = drills.blank(r.deliveries, "temperature_breach_flag", F.col("delivery_id") % 47 == 8)
    return hurt.select("delivery_id", "temperature_breach_flag")


@query("inject_price_drift", """
select order_line_id, case when order_id % 63 = 20
  then cast(unit_price * cast((60 + customer_id % 90) * 0.01 as decimal(5,2)) as decimal(10,2)) else unit_price end as unit_price
from lines_raw""")
def _(r):
    factor = ((F.col("customer_id") % 90 + 60) * F.expr("0.01")).cast("decimal(5,2)")
    hurt = drills.scale_price(r.order_lines, "unit_price", F.col("order_id") % 63 == 20, factor)
    return hurt.select("order_line_id", "unit_price")


@query("inject_time_inversion", """
select delivery_id, dispatched_at,
       case when delivery_id % 109 = 15 then dispatched_at - interval 2 hours else delivered_at end as delivered_at
from deliveries_raw""")
def _(r):
    hurt = drills.invert_times(r.deliveries, "dispatched_at", "delivered_at", F.col("delivery_id") % 109 == 15)
    return hurt.select("delivery_id", "dispatched_at", "delivered_at")


@query("inject_ghost_rows", f"""
select delivery_id, order_id from deliveries_raw union all
select delivery_id + {GHOST_OFFSET}, order_id + {GHOST_OFFSET} from deliveries_raw where delivery_id % 150 = 26""")
def _(r):
    hurt = drills.ghost_rows(r.deliveries, F.col("delivery_id") % 150 == 26, ["delivery_id", "order_id"], GHOST_OFFSET)
    return hurt.select("delivery_id", "order_id")


@query("inject_spelling", f"""
select delivery_id, case when delivery_id % 24 = 9 then {list(STRAY_STATUS)}[order_id % 5 + 1] else status end as status
from deliveries_t""")
def _(r):
    hurt = drills.respell(typed(r)["deliveries"], "status", F.col("delivery_id") % 24 == 9, STRAY_STATUS, F.col("order_id"))
    return hurt.select("delivery_id", "status")


@query("inject_sign_flip", """
select delivery_id, case when delivery_id % 333 = 22 then -distance_km else distance_km end as distance_km from deliveries_raw""")
def _(r):
    hurt = drills.flip_sign(r.deliveries, "distance_km", F.col("delivery_id") % 333 == 22)
    return hurt.select("delivery_id", "distance_km")


@query("inject_dup_master", "select * from products_raw union all select * from products_raw where product_id % 29 = 4")
def _(r):
    return drills.repeat_rows(r.products, F.col("product_id") % 29 == 4)


@query("inject_negative_margin", """
select product_id, unit_cost, case when product_id % 37 = 6 then cast(unit_cost * 0.91 as decimal(10,2)) else unit_price end as unit_price
from products_raw""")
def _(r):
    hurt = drills.negative_margin(r.products, "unit_price", "unit_cost", F.col("product_id") % 37 == 6)
    return hurt.select("product_id", "unit_cost", "unit_price")


# Every rule sees its own defect: classes of keys, each hurt in one way, on tables that passed the gate.
_HURT = """
with p as (select product_id % 23 as d from products_s),
o as (select order_id % 97 as d, requested_delivery_date is null as undated, product_id in (select product_id from products_s) as known
      from lines_s),
v as (select delivery_id % 97 as d from deliveries_s),
found(rule, "table", action, clean_violations, hurt_violations) as (
  select 'R1', 'products', 'FAIL', 0, (select count(*) from p where d = 5) union all
  select 'R2', 'products', 'FAIL', 0, (select count(*) from p where d = 6) union all
  select 'R4', 'orders', 'FAIL', 0, (select count(*) from o where d = 1) union all
  select 'R5', 'orders', 'WARN', (select count(*) from o where undated), (select count(*) from o where d <> 1 and (d = 5 or undated)) union all
  select 'R6', 'orders', 'FAIL', 0, (select count(*) from o where d = 2) union all
  select 'R7', 'orders', 'FAIL', 0, (select count(*) from o where d = 3) union all
  select 'R8', 'orders', 'FAIL', 0, (select count(*) from o where d = 4 and known) union all
  select 'R17', 'orders', 'WARN', (select count(*) from o where not known),
         (select count(*) from o where d not in (1, 2, 3) and (d = 6 or not known)) union all
  select 'R10', 'deliveries', 'FAIL', 0, (select count(*) from v where d = 1) union all
  select 'R12', 'deliveries', 'FAIL', 0, (select count(*) from v where d = 2) union all
  select 'R13', 'deliveries', 'FAIL', 0, (select count(*) from v where d = 3) union all
  select 'R14', 'deliveries', 'FAIL', 0, (select count(*) from v where d = 4))
select rule, "table", cast(clean_violations as bigint) as clean_violations, cast(hurt_violations as bigint) as hurt_violations,
       case when clean_violations = 0 then 'PASS' else action end as clean_status,
       case when hurt_violations = 0 then 'PASS' else action end as hurt_status
from found"""


@query("defect_drill", _HURT)
def _(r):
    kept = {name: df.drop("_dq_r5", "_dq_r17") for name, df in silver_plan.settled_silver(typed(r)).items()}
    d = F.col("order_id") % 97
    products = drills.repeat_rows(kept["products"], F.col("product_id") % 23 == 5,
                                  {"shelf_life_days": F.col("shelf_life_days") + 1})
    products = drills.negative_margin(products, "unit_price", "unit_cost", F.col("product_id") % 23 == 6)
    orders = drills.repeat_rows(kept["orders"], d == 1, {"quantity": F.col("quantity") + 1})
    orders = drills.non_positive(orders, "quantity", d == 2, [-3, 0, -8], F.col("customer_id"))
    orders = drills.orphan_keys(orders, "depot_id", d == 3, [-301, -302], F.col("customer_id"))
    orders = drills.scale_price(orders, "unit_price", d == 4, F.expr("1.50"))
    orders = drills.blank(orders, "requested_delivery_date", d == 5)
    orders = drills.orphan_keys(orders, "product_id", d == 6, [-301], F.lit(0))
    g = F.col("delivery_id") % 97
    deliveries = drills.orphan_keys(kept["deliveries"], "order_id", g == 1, [-301], F.lit(0))
    deliveries = drills.blank(deliveries, "temperature_breach_flag", g == 2)
    deliveries = drills.invert_times(deliveries, "dispatched_at", "delivered_at", g == 3)
    deliveries = drills.flip_sign(deliveries, "distance_km", g == 4)

    def judged(p, o, v):
        """Every table against sound parents, so one defect cannot cause another."""
        return gate.rule_results([
            silver_plan.tag_products(p), silver_plan.tag_orders(o, kept["depots"], kept["products"], to_count=True),
            silver_plan.tag_deliveries(v, kept["orders"])])

    clean = judged(kept["products"], kept["orders"], kept["deliveries"]).select(
        "rule", F.col("violations").alias("clean_violations"), F.col("status").alias("clean_status"))
    hurt = judged(products, orders, deliveries).select(
        "rule", "table", F.col("violations").alias("hurt_violations"), F.col("status").alias("hurt_status"))
    return hurt.join(clean, "rule")
