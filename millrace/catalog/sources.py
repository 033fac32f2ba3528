"""Sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.base import gold, query, silver, typed
from millrace.plans import gold as gold_plan
from millrace.plans import measures
from millrace.plans import silver as silver_plan
from millrace.session import work_folder
from millrace.sources import audit, raw, tables
from millrace.sources.retail import RetailTables
from millrace.streaming import bronze

BATCH = "batch-1"


def _csv(r: RetailTables, name: str) -> str:
    return raw.export_csv(raw.as_text(r.all[name]), work_folder(r.spark, f"csv-{name}"))


def _table_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:8]}"


@query("scan_raw_csv", "select columns(*)::varchar from lines_raw")
def _(r):
    columns = r.order_lines.columns
    return raw.read_raw(r.spark, _csv(r, "orders"), columns)


@query("scan_inferred_csv", """
select delivery_id, order_id, depot_id, vehicle_id, dispatched_at, delivered_at, status,
       temperature_breach_flag, cast(distance_km as double) as distance_km
from deliveries_raw""")
def _(r):
    inferred = raw.read_inferred(r.spark, _csv(r, "deliveries"))
    ids = ("delivery_id", "order_id", "depot_id", "vehicle_id")
    return inferred.withColumns({c: F.col(c).cast("bigint") for c in ids})


@query("export_csv", "select columns(*)::varchar from depots_raw")
def _(r):
    return raw.read_raw(r.spark, _csv(r, "depots"))


@query("stamp_lineage", """
select *, 'events.parquet' as _source_file, 'batch-1' as _ingest_batch, true as stamped from events""")
def _(r):
    stamped = raw.stamp(r.source("events"), BATCH)
    return stamped.withColumn("stamped", F.col("_ingested_at").isNotNull()).drop("_ingested_at")


@query("write_bronze", "select columns(*)::varchar, 'orders.csv' as _source_file from lines_raw")
def _(r):
    landed = raw.stamp(raw.as_text(r.order_lines), BATCH, "orders.csv")
    name = _table_name("bronze_orders")
    table = tables.write_table(landed, name, path=work_folder(r.spark, name))
    return table.drop("_ingested_at", "_ingest_batch")


def _landed(r: RetailTables) -> dict[str, DataFrame]:
    return {name: tables.settle(df, f"bronze-{name}") for name, df in r.all.items()}


_COUNTS = """
select 'products' as "table", count(*) as n_rows from products_raw union all
select 'depots', count(*) from depots_raw union all
select 'orders', count(*) from lines_raw union all
select 'deliveries', count(*) from deliveries_raw"""


@query("ingest_row_audit", _COUNTS)
def _(r):
    return audit.row_audit(_landed(r))


@query("ingest_count_gate", f"""
select "table", n_rows as source_rows, landed_rows, case when n_rows = landed_rows then 'PASS' else 'HALT' end as status
from (select "table", n_rows, case "table" when 'orders' then (select count(*) from lines_raw where quantity > 0)
             else n_rows end as landed_rows from ({_COUNTS}))""")
def _(r):
    # A landing that lost the order lines without a quantity above zero.
    landed = dict(_landed(r))
    landed["orders"] = landed["orders"].filter(F.col("quantity").cast("int") > 0)
    return audit.count_gate(r.all, landed)


@query("table_shapes", f"""
select "table", n_rows, case "table" when 'products' then 7 when 'depots' then 6 else 9 end as n_cols
from ({_COUNTS})""")
def _(r):
    return audit.table_shapes(r.all)


@query("scan_table", "select * from products_raw")
def _(r):
    name = _table_name("bronze_products")
    tables.write_table(r.products, name, path=work_folder(r.spark, name))
    return tables.scan_table(r.spark, name)


@query("write_silver", "select * from lines_s")
def _(r):
    return _run(r).tables["orders"]


def _run(r: RetailTables) -> silver_plan.SilverRun:
    prefix = _table_name("silver") + "_"
    return silver_plan.publish_silver(typed(r), prefix, location=work_folder(r.spark, prefix))


@query("write_quarantine", "select _dq_table, _dq_rule, count(*) as n_rows from rejected_all group by all")
def _(r):
    return _run(r).quarantine.groupBy("_dq_table", "_dq_rule").agg(F.count(F.lit(1)).alias("n_rows"))


@query("source_ref", """
select 'silver_products' as source, count(*) as n_rows from products_s union all
select 'silver_depots', count(*) from depots_s union all
select 'silver_orders', count(*) from lines_s union all
select 'silver_deliveries', count(*) from deliveries_s union all
select 'bronze_products', count(*) from products_raw""")
def _(r):
    registry = tables.SourceRegistry(r.spark)
    for name, df in silver(r).items():
        registry.add(f"silver_{name}", df)
    registry.add("bronze_products", r.products)
    counts = audit.row_audit({name: registry.ref(name) for name in registry.names()})
    return counts.withColumnRenamed("table", "source")


@query("staging_view", "select * from fact_deliveries")
def _(r):
    staged = gold_plan.stg_deliveries(silver(r)["deliveries"])
    return tables.staging_view(staged, _table_name("stg_deliveries"))


@query("mart_table", "select * from fact_orders")
def _(r):
    facts = {"fact_orders": gold(r)["fact_orders"]}
    prefix = _table_name("gold") + "_"
    return gold_plan.publish_gold(facts, prefix, location=work_folder(r.spark, prefix))["fact_orders"]


@query("serve_scan", "select measure, value from measures where measure = 'Total Revenue'")
def _(r):
    facts = {"fact_orders": tables.settle(gold(r)["fact_orders"], "gold-fact_orders")}
    return measures.evaluate(facts, "Total Revenue")


@query("stream_bronze", "select *, 'events.parquet' as _source_file from events")
def _(r):
    schema = r.source("events").schema
    stream = bronze.read_files(r.spark, r.folder, schema, glob="events.parquet")
    target = work_folder(r.spark, "bronze-events")
    bronze.stream_bronze(stream, BATCH, target, work_folder(r.spark, "stream")).awaitTermination()
    return r.spark.read.parquet(target).drop("_ingested_at", "_ingest_batch")


@query("stream_row_audit", "select cast(0 as bigint) as batch_id, count(*) as n_rows from events")
def _(r):
    schema = r.source("events").schema
    stream = bronze.read_files(r.spark, r.folder, schema, glob="events.parquet")
    log = work_folder(r.spark, "landing-log")
    bronze.stream_row_audit(
        stream, work_folder(r.spark, "bronze-events"), log, work_folder(r.spark, "stream"), BATCH
    ).awaitTermination()
    return r.spark.read.parquet(log).select("batch_id", "n_rows")
