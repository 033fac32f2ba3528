"""The four business tables, derived row by row from TPC-H style tables.

`lineitem`, `orders`, `part`, `supplier`, `nation` and `region` become order
lines, products, depots and deliveries with defects placed by key arithmetic,
so every count is repeatable. Each derived row depends on its own source rows
only: no numbering within an order, no window, and the injected copies come
from an `explode` of the row itself. A hot order or part is therefore never
gathered anywhere. The two large tables are written once per folder and session, as a landing
zone would hold them. FIXTURES.md lists the arithmetic.
"""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.tables import Frames, settle

NO_DEPOT = 770000
GHOST_OFFSET = 1_000_000_000

# Spellings of a status that conform to the four valid ones.
STRAY_STATUS = ("delivered", "Delivered", " DELIVERED", "DELIVERED ", "failed")


def _copies(condition: str) -> str:
    """0 for the row itself, 1 for its copy where the condition holds."""
    return f"explode(if({condition}, array(0, 1), array(0))) as copy_no"


class RetailTables:
    """Lazy frames over one folder of source tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._read = cache(lambda name: spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def source(self, name: str) -> DataFrame:
        return self._read(name)

    @cached_property
    def order_lines(self) -> DataFrame:
        item = self.source("lineitem")
        head = self.source("orders")
        part = self.source("part")
        return settle(
            item.join(head, item.l_orderkey == head.o_orderkey)
            .join(part, item.l_partkey == part.p_partkey)
            .selectExpr(
                "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as order_line_id",
                "l_orderkey", "l_partkey", "l_suppkey", "o_custkey", "o_orderdate",
                "cast(l_quantity as int) as units",
                "cast(p_retailprice as decimal(10,2)) as list_price",
                "l_orderkey * 31 + l_linenumber * 17 as h",
            )
            .selectExpr("*", _copies("h % 190 = 21"))
            .selectExpr(
                "order_line_id",
                "l_orderkey as order_id",
                "o_custkey as customer_id",
                f"if(h % 170 = 4, h % 4 + {NO_DEPOT}, l_suppkey) as depot_id",
                "l_partkey as product_id",
                "o_orderdate as order_datetime",
                "if(h % 95 = 11, null, date_add(cast(o_orderdate as date), cast(h % 9 + 2 as int)))"
                " as requested_delivery_date",
                "if(h % 230 = 9, cast(-(h % 11) as int), units)"
                " + if(copy_no = 1 and h % 2090 = 21, 1, 0) as quantity",
                "if(h % 52 = 15, cast(list_price * (h % 80 + 61) * 0.01 as decimal(10,2)), list_price)"
                " as unit_price",
            ), "order-lines"
        )

    @cached_property
    def products(self) -> DataFrame:
        return (
            self.source("part")
            .selectExpr("*", "cast(p_retailprice as decimal(10,2)) as list_price", _copies("p_partkey % 330 in (5, 111)"))
            .selectExpr("*", "cast(list_price * 0.64 as decimal(10,2)) as unit_cost")
            .selectExpr(
                "p_partkey as product_id", "p_name as product_name", "p_brand as category",
                "p_type as temperature_zone", "unit_cost",
                "if(p_partkey % 19 = 6, cast(unit_cost * 0.93 as decimal(10,2)), list_price) as unit_price",
                "p_size + if(copy_no = 1 and p_partkey % 330 = 111, 1, 0) as shelf_life_days",
            )
        )

    @cached_property
    def depots(self) -> DataFrame:
        supplier, nation, region = (self.source(n) for n in ("supplier", "nation", "region"))
        return (
            supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .selectExpr(
                "s_suppkey as depot_id", "s_name as depot_name",
                "case when s_suppkey % 14 = 3 then concat(' ', lower(n_name))"
                " when s_suppkey % 14 = 9 then upper(n_name) else n_name end as city",
                "r_name as region", "s_suppkey % 1500 + 250 as capacity_pallets",
                "date_add(date'2011-03-01', cast(s_suppkey % 4100 as int)) as opened_date",
            )
        )

    @cached_property
    def deliveries(self) -> DataFrame:
        """One delivery for every order that has a line, plus ghost copies; some are only scheduled."""
        head = self.source("orders")
        first = self.source("lineitem").groupBy("l_orderkey").agg({"l_suppkey": "min"}).toDF("k", "depot")
        spelling = ", ".join(f"'{v}'" for v in STRAY_STATUS)
        return settle(
            head.join(first, head.o_orderkey == first.k)
            .selectExpr("k", "depot", "o_orderdate", "k * 13 + 3 as g")
            .selectExpr(
                "*", "o_orderdate + make_dt_interval(cast(g % 6 + 1 as int), cast(g % 9 + 3 as int)) as sent",
                "cast((g % 1700 + 22) * 0.1 as decimal(10,2)) as km", _copies("g % 185 = 16"),
            )
            .selectExpr(
                f"k + copy_no * {GHOST_OFFSET} as delivery_id",
                f"k + copy_no * {GHOST_OFFSET} as order_id",
                "depot as depot_id", "k % 90 + 1 as vehicle_id", "sent as dispatched_at",
                "sent + make_dt_interval(0, 0, if(g % 131 = 12, -95, cast(g % 410 + 25 as int))) as delivered_at",
                f"case when k % 90 >= 84 then 'SCHEDULED' when g % 23 = 7 then element_at(array({spelling}), cast(g % 5 + 1 as int))"
                " when g % 100 < 83 then 'DELIVERED' when g % 100 < 91 then 'FAILED'"
                " when g % 100 < 96 then 'RETURNED' else 'PARTIAL' end as status",
                "if(g % 49 = 5, null, g % 31 = 2) as temperature_breach_flag",
                "if(g % 310 = 14, -km, km) as distance_km",
            ), "deliveries"
        )

    @cached_property
    def all(self) -> Frames:
        return Frames({
            "products": lambda: self.products,
            "depots": lambda: self.depots,
            "orders": lambda: self.order_lines,
            "deliveries": lambda: self.deliveries,
        })
