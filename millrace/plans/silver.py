"""Typing, the twelve contracts, and the fail-closed publication of the silver layer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import cleanse as c
from millrace.operators import gate
from millrace.operators.history import FROM, TO, as_of, extend
from millrace.operators.references import known_keys, lookup, mark_parent, one_per_key
from millrace.operators.rules import (
    CLEANSE, DOCUMENT, FAIL, WARN, ForeignKeyRule, Lookup, RegisterEntry, RowRule, UniqueRule,
)
from millrace.operators.tagging import FIRST, Tagged, survivors, tag
from millrace.plans.runs import QUARANTINE, RUN_LOG, Run, log_entries
from millrace.sources.snapshots import FAILED, HALT, PASS, Snapshot, SnapshotStore, name_views
from millrace.sources.tables import Frames, settle

THRESHOLD_PCT = 5.0
MASTER_PRICE = "_master_price"
HISTORY = "product_history"


def type_products(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "unit_cost": c.to_double("unit_cost"),
        "unit_price": c.to_double("unit_price"),
        "shelf_life_days": c.to_int("shelf_life_days"),
    })


def type_depots(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "city": c.conform_title("city"),
        "capacity_pallets": c.to_int("capacity_pallets"),
        "opened_date": c.to_date("opened_date"),
    })


def type_orders(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "order_datetime": c.to_timestamp("order_datetime"),
        "requested_delivery_date": c.to_date("requested_delivery_date"),
        "quantity": c.to_int("quantity"),
        "unit_price": c.to_double("unit_price"),
    })


def type_deliveries(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "status": c.conform_upper("status"),
        "dispatched_at": c.to_timestamp("dispatched_at"),
        "delivered_at": c.to_timestamp("delivered_at"),
        "distance_km": c.to_double("distance_km"),
        "temperature_breach_flag": c.to_boolean("temperature_breach_flag"),
    })


def conform(tables: Mapping[str, DataFrame]) -> Frames:
    """City and status spellings of already typed tables."""
    return Frames({
        "products": lambda: tables["products"],
        "depots": lambda: tables["depots"].withColumn("city", c.conform_title("city")),
        "orders": lambda: tables["orders"],
        "deliveries": lambda: tables["deliveries"].withColumn("status", c.conform_upper("status")),
    })


def type_all(raw: Mapping[str, DataFrame]) -> Frames:
    """The four raw text tables, typed."""
    return Frames({
        "products": lambda: type_products(raw["products"]),
        "depots": lambda: type_depots(raw["depots"]),
        "orders": lambda: type_orders(raw["orders"]),
        "deliveries": lambda: type_deliveries(raw["deliveries"]),
    })


def product_rules() -> list:
    return [
        UniqueRule("R1", "product_id", "a product id occurs once"),
        RowRule("R2", "unit_price", "a product is not sold below cost", FAIL,
                bad=F.col("unit_cost") > F.col("unit_price")),
    ]


def order_rules(depots: DataFrame) -> list:
    """R8 and R17 read the master price that the lookup of `tag_orders` adds."""
    drift = F.col(MASTER_PRICE).isNotNull() & c.money_differs("unit_price", MASTER_PRICE)
    return [
        UniqueRule("R4", "order_line_id", "an order line id occurs once"),
        RowRule("R5", "requested_delivery_date", "a delivery date was requested", WARN,
                bad=F.col("requested_delivery_date").isNull()),
        RowRule("R6", "quantity", "a quantity is above zero", FAIL, bad=F.col("quantity") <= 0),
        ForeignKeyRule("R7", "depot_id", "the depot of an order line exists", FAIL,
                       parent=depots, parent_column="depot_id"),
        RowRule("R8", "unit_price", "a line price equals the master price", FAIL, bad=drift),
        RowRule("R17", "product_id", "the product of a line is in the silver master", WARN,
                bad=F.col(MASTER_PRICE).isNull()),
    ]


def delivery_rules(orders: DataFrame) -> list:
    return [
        ForeignKeyRule("R10", "order_id", "the order of a delivery exists", FAIL,
                       parent=orders, parent_column="order_id"),
        RowRule("R12", "temperature_breach_flag", "the cold chain outcome is known", FAIL,
                bad=F.col("temperature_breach_flag").isNull()),
        RowRule("R13", "delivered_at", "a delivery ends after it starts", FAIL,
                bad=F.col("delivered_at") < F.col("dispatched_at")),
        RowRule("R14", "distance_km", "a distance is not negative", FAIL, bad=F.col("distance_km") < 0),
    ]


def tag_products(products: DataFrame) -> Tagged:
    return tag(products, "products", product_rules(), drop_identical=True)


def tag_depots(depots: DataFrame) -> Tagged:
    """Depots have no rule, so every row survives."""
    return Tagged("depots", depots.withColumn(FIRST, F.lit(None).cast("int")), ())


def tag_orders(orders: DataFrame, depots: DataFrame, silver_products: DataFrame, to_count: bool = False) -> Tagged:
    master = Lookup("product_id", silver_products, "product_id", {"unit_price": MASTER_PRICE})
    known = known_keys(depots, "depot_id")
    return tag(orders, "orders", order_rules(known), [master], drop_identical=True, to_count=to_count)


def tag_orders_as_of(orders: DataFrame, depots: DataFrame, product_history: DataFrame) -> Tagged:
    """Orders judged by the price that was valid when they were placed (R8), and by the members of that time (R17).

    The priced orders are written, as the rules on keys read them several times (runs jobs).
    """
    priced = settle(as_of(orders, "product_id", "order_datetime", product_history, "product_id",
                          {"unit_price": MASTER_PRICE}), "priced-orders")
    judged = tag(priced, "orders", order_rules(known_keys(depots, "depot_id")), drop_identical=True)
    return Tagged(judged.table, judged.frame, judged.rules, (MASTER_PRICE,))


def load_master(store: SnapshotStore, products: DataFrame, run: Run, moment: dt.datetime) -> Snapshot:
    """Extend the store's history of products by one load of their master (runs jobs); a repeated run changes nothing."""
    if (done := store.of_run(run.run_id)) is not None:
        return done
    last = store.latest()
    known = last.table(HISTORY) if last and HISTORY in last.names() else None
    if known is not None:
        newest = known.agg(F.max(F.greatest(FROM, TO))).first()[0]
        if newest is not None and newest >= moment.replace(tzinfo=None):
            raise ValueError(f"a load of {moment} comes after one of {newest}")
    return store.publish(run.run_id, {HISTORY: extend(known, products, ["product_id"], moment)})


def tag_deliveries(deliveries: DataFrame, silver_orders: DataFrame) -> Tagged:
    return tag(deliveries, "deliveries", delivery_rules(silver_orders))


def tag_all(tables: Mapping[str, DataFrame]) -> Frames:
    """Lazy verdicts (`Tagged`) on typed, conformed tables; children draw on their parents'."""
    verdicts = Frames({
        "products": lambda: tag_products(tables["products"]),
        "depots": lambda: tag_depots(tables["depots"]),
        "orders": lambda: tag_orders(tables["orders"], tables["depots"], survivors(verdicts["products"])),
        "deliveries": lambda: tag_deliveries(tables["deliveries"], survivors(verdicts["orders"])),
    })
    return verdicts


def silver(tables: Mapping[str, DataFrame]) -> Frames:
    """Lazy survivors of the four tables."""
    verdicts = tag_all(tables)
    return Frames({name: (lambda name=name: survivors(verdicts[name])) for name in verdicts})


GATED = ("products", "orders", "deliveries")


def results(tagged: Mapping[str, Tagged]) -> DataFrame:
    return gate.rule_results([tagged[n] for n in GATED])


def judged_results(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rule results of typed tables, each judged once (runs jobs).

    Of the verdicts on parents only what is counted, and what their children are judged by, is written; whole rows
    are written nowhere.
    """
    products = _verdicts(tag_products(tables["products"]), "product_id", "unit_price")
    orders = _verdicts(tag_orders(tables["orders"], tables["depots"], survivors(products), to_count=True),
                       "order_line_id", "order_id")
    return gate.rule_results([products, orders, tag_deliveries(tables["deliveries"], survivors(orders))])


def _verdicts(tagged: Tagged, *columns: str) -> Tagged:
    """Some columns of a tagged table and its verdicts, written."""
    kept = tagged.frame.select(*columns, FIRST, *tagged.flags)
    return Tagged(tagged.table, settle(kept, f"verdicts-{tagged.table}"), tagged.rules)


@dataclass(frozen=True)
class SilverRun:
    results: DataFrame
    totals: DataFrame
    quarantine: DataFrame
    tables: dict[str, DataFrame]
    snapshot: Snapshot


RESULTS, TOTALS = "rule_results", "gate_totals"


def publish_silver(
    tables: Mapping[str, DataFrame],
    prefix: str = "silver_",
    max_pct: float = THRESHOLD_PCT,
    fmt: str = "parquet",
    location: str | None = None,
    run: Run | None = None,
    append: Sequence[str] = (),
) -> SilverRun:
    """Judge, quarantine, enforce, and only then publish (runs jobs).

    Each table is tagged once and written to the shared work folder, parents
    first: counts, quarantine and silver all read that one result, and later
    tables join parents whose size Spark knows from their files.

    Everything is committed as one version of the store at `location`: survivors, quarantine, counts and the run
    log. A halted load commits its quarantine and its log rows beside the tables of the version before, so it can be
    triaged. A load that breaks off changes no table and is logged as FAILED; one that is killed leaves
    no trace. A run that ended before is not judged again: its version is returned, or its halt raised once more.
    `append` names tables that keep the rows of earlier runs; the others are replaced. The views
    `prefix` + table show the version that this call returns.
    """
    spark = next(iter(tables.values())).sparkSession
    store = SnapshotStore(spark, location or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{prefix}store", fmt)
    run = run or Run()
    if (done := store.of_run(run.run_id)) is not None:
        return _ended(done, prefix, run)
    base, started = store.latest(), run.clock()
    tagged = _judged(tables)
    log = settle(results(tagged), "rule-results")
    totals = settle(gate.gate_totals(log, gate.rows_in(list(tables.values())), max_pct), "gate-totals")
    halted = totals.first()["status"] == HALT
    status = HALT if halted else PASS

    def entries(how: str) -> dict:
        return store.stage(RUN_LOG, log_entries(run, tables, tagged, log, started, run.clock(), how), run.run_id)

    try:
        silver_rows = {} if halted else {n: store.stage(n, survivors(t), run.run_id) for n, t in tagged.items()}
        added = {n: part for n, part in silver_rows.items() if n in append}
        held = gate.quarantine([tagged[n] for n in GATED])
        added |= {QUARANTINE: store.stage(QUARANTINE, held, run.run_id), RUN_LOG: entries(status),
                  RESULTS: store.stage(RESULTS, log, run.run_id), TOTALS: store.stage(TOTALS, totals, run.run_id)}
        replaced = {n: part for n, part in silver_rows.items() if n not in append}
        snapshot = store.commit(run.run_id, status, replaced, added, base)
    except Exception:
        store.commit(run.run_id, FAILED, {}, {RUN_LOG: entries(FAILED)}, base)
        raise
    return _ended(snapshot, prefix, run)


def _ended(snapshot: Snapshot, prefix: str, run: Run) -> SilverRun:
    """What a run left, under its names; raises if it was halted."""
    snapshot.table(QUARANTINE, run_id=run.run_id).createOrReplaceTempView("quarantine_" + prefix.rstrip("_"))
    totals = snapshot.table(TOTALS, run_id=run.run_id)
    gate.raise_if_halted(totals)
    named = name_views(snapshot, {n: prefix + n for n in (*GATED, "depots")})
    return SilverRun(snapshot.table(RESULTS, run_id=run.run_id), totals,
                     snapshot.table(QUARANTINE, run_id=run.run_id), named, snapshot)


def settled_silver(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Survivors of the four tables, each judged once and written, parents first (runs jobs)."""
    tagged = _judged(tables)
    return {name: survivors(t) for name, t in tagged.items()}


def _judged(tables: Mapping[str, DataFrame]) -> dict[str, Tagged]:
    depots = tables["depots"]
    products = _settled(tag_products(tables["products"]))
    orders = _settled(tag_orders(tables["orders"], depots, survivors(products)))
    deliveries = _settled(tag_deliveries(tables["deliveries"], survivors(orders)))
    return {"products": products, "depots": tag_depots(depots), "orders": orders, "deliveries": deliveries}


def _settled(tagged: Tagged) -> Tagged:
    return tagged.replace(settle(tagged.frame, f"tagged-{tagged.table}"))


def price_disagreements(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines whose price differs from a product master, with `master_price` added."""
    joined = lookup(lines, "product_id", products, "product_id", {"unit_price": "master_price"})
    return joined.filter(F.col("master_price").isNotNull() & c.money_differs("unit_price", "master_price"))


def cascade_report(lines: DataFrame, raw_products: DataFrame, silver_products: DataFrame) -> DataFrame:
    """Price disagreements by cause: (cause, n_lines).

    CASCADE lines disagree with a master row that a contract withdraws anyway;
    GENUINE lines disagree with a master row that stays.
    """
    drifted = price_disagreements(lines, one_per_key(raw_products, "product_id"))
    causes = mark_parent(drifted, "product_id", silver_products, "product_id", "_kept")
    cause = F.when(F.col("_kept"), "GENUINE").otherwise("CASCADE")
    return causes.groupBy(cause.alias("cause")).agg(F.count(F.lit(1)).alias("n_lines"))


def escalation_list(quarantined_orders: DataFrame) -> DataFrame:
    """Genuine price drift per product, for the owner of the product master."""
    expected = f"_dq_expected{MASTER_PRICE}"
    return (
        quarantined_orders.filter(F.col("_dq_rule") == "R8")
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.min("unit_price").alias("min_price"),
             F.max("unit_price").alias("max_price"), F.max(expected).alias("master_price"))
    )


# The register of findings behind the contracts: what is wrong, and what is done about it.
REGISTER = (
    RegisterEntry("R1", "products", "product_id", "key repeats", FAIL, "a repeated dimension key multiplies facts"),
    RegisterEntry("R2", "products", "unit_price", "price below cost", FAIL, "taken as an entry error"),
    RegisterEntry("R3", "depots", "city", "stray case and blanks", CLEANSE, "the right spelling is certain"),
    RegisterEntry("R4", "orders", "order_line_id", "key repeats", FAIL, "revenue would count twice"),
    RegisterEntry("R5", "orders", "requested_delivery_date", "missing", WARN, "the order stands, only lateness is unknown"),
    RegisterEntry("R6", "orders", "quantity", "zero or less", FAIL, "no such quantity exists"),
    RegisterEntry("R7", "orders", "depot_id", "no such depot", FAIL, "regional totals would fall short"),
    RegisterEntry("R8", "orders", "unit_price", "differs from the master", FAIL, "escalated to the master's owner"),
    RegisterEntry("R9", "orders", "customer_id", "no parent table supplied", DOCUMENT, "kept as a degenerate dimension"),
    RegisterEntry("R10", "deliveries", "order_id", "no such order", FAIL, "nothing was ordered to deliver"),
    RegisterEntry("R11", "deliveries", "status", "stray case and blanks", CLEANSE, "the right spelling is certain"),
    RegisterEntry("R12", "deliveries", "temperature_breach_flag", "missing", FAIL, "unknown must not read as held"),
    RegisterEntry("R13", "deliveries", "delivered_at", "before dispatch", FAIL, "cannot happen"),
    RegisterEntry("R14", "deliveries", "distance_km", "negative", FAIL, "no such distance exists"),
    RegisterEntry("R15", "deliveries", "vehicle_id", "no parent table supplied", DOCUMENT, "kept as a degenerate dimension"),
    RegisterEntry("R16", "all", "dates and times", "stored as text", CLEANSE, "parsed on the way to silver"),
    RegisterEntry("R17", "orders", "product_id", "withdrawn from the master", WARN, "a valid sale outlives its product row"),
)
