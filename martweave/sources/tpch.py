"""Order tables in the TPC-H layout, seen as the landing tables.

Only the columns asked for are derived: an order's item count and an item's user
take a join each, which a query that does not use them should not pay for.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.functions.calendar import moment
from martweave.sources.landing import LANDINGS

# Status codes of the order tables and the statuses they stand for.
ORDER_STATUS = {"F": "Complete", "O": "Processing", "P": "Shipped"}
ITEM_STATUS = {"R": "Returned", "A": "Cancelled", "N": "Complete"}

# What tells lines apart: no two agree in all of these at the scales at hand.
ITEM_KEYS = ("order_id", "id", "product_id", "inventory_item_id", "created_at")
LANDED = {**LANDINGS, "order_items": replace(LANDINGS["order_items"], keys=ITEM_KEYS)}

# An item is created this long after its ship date, to give it a time of day.
ITEM_DELAY_HOURS = 23


def _decode(column: str, names: dict[str, str]) -> Column:
    coded = F.col(column)
    chosen = F  # the first ``when`` starts the expression, the others extend it
    for code, name in names.items():
        chosen = chosen.when(coded == code, name)
    return chosen


def _later(start: Column, hours: Column | int) -> Column:
    """Hours added as plain integers, which is far cheaper than an interval."""
    step = F.lit(hours) if isinstance(hours, int) else hours.cast("bigint")
    return F.timestamp_micros(F.unix_micros(start) + step * 3_600_000_000)


def _at_or_after(column: str, bound: datetime | None, shift: timedelta = timedelta()) -> Column:
    """The bound on the stored column itself, so that it reaches the parquet scan."""
    if bound is None:
        return F.lit(True)
    return F.col(column) >= moment(bound - shift).cast("timestamp_ntz")


def _line_id() -> Column:
    """A line has no key of its own, and line numbers repeat within an order.

    Order and line fill the upper 32 bits, part and supplier the lower 31, each
    wrapped round; it never overflows. Two lines may share an id (one pair does at a
    scale of 0.001), so landing does not merge on it alone: see ``ITEM_KEYS``.
    """
    upper = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) % (1 << 32)
    lower = (F.col("l_partkey") * 100_003 + F.col("l_suppkey")) % ((1 << 31) - 1)
    return upper * (1 << 31) + lower


class OrderTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def read(self, source: str, table: str, start: datetime | None = None) -> DataFrame:
        """The registry's way in; a cursor value to start from reaches the scan."""
        landing = LANDED[table]
        if landing.source != source:
            raise KeyError(f"no source {source}.{table}")
        make = getattr(self, table)
        return make() if landing.cursor is None else make(since=start)

    def users(self) -> DataFrame:
        customer, nation, region = map(self.table, ("customer", "nation", "region"))
        placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
            region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        key, name = F.col("c_custkey"), F.col("c_name")
        unknown = F.lit(None)
        return placed.select(
            key.alias("id"),
            name.alias("first_name"),
            name.alias("last_name"),
            F.when(key % 10 != 0, F.concat(name, F.lit("@example.com"))).alias("email"),
            (F.lit(18) + key % 60).alias("age"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            F.col("r_name").alias("state"),
            F.concat(name, F.lit(" street")).alias("street_address"),
            unknown.cast("string").alias("postal_code"),
            unknown.cast("string").alias("city"),
            F.col("n_name").alias("country"),
            unknown.cast("double").alias("latitude"),
            unknown.cast("double").alias("longitude"),
            F.col("c_mktsegment").alias("traffic_source"),
            F.date_add(F.lit("1994-01-01").cast("date"), (key % 365).cast("int"))
            .cast("timestamp")
            .alias("created_at"),
        )

    def products(self) -> DataFrame:
        """A part of a size divisible by ten has no known cost."""
        size, price = F.col("p_size"), F.col("p_retailprice")
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            F.when(size % 10 != 0, price).alias("cost"),
            F.col("p_type").alias("category"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"),
            price.alias("retail_price"),
            F.when(size % 2 == 0, "Women").otherwise("Men").alias("department"),
            F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
            (size % 10).cast("bigint").alias("distribution_center_id"),
        )

    def orders(
        self, columns: Collection[str] | None = None, since: datetime | None = None
    ) -> DataFrame:
        wanted = LANDINGS["orders"].columns if columns is None else list(columns)
        orders = self.table("orders").filter(_at_or_after("o_orderdate", since))
        if "num_of_item" in wanted:
            counts = (
                self.table("lineitem")
                .groupBy(F.col("l_orderkey").alias("o_orderkey"))
                .agg(F.count(F.lit(1)).alias("_items"))
            )
            orders = orders.join(counts, "o_orderkey", "left")
        created = F.col("o_orderdate").cast("timestamp")
        status = F.col("o_orderstatus")
        derived = {
            "order_id": F.col("o_orderkey"),
            "user_id": F.col("o_custkey"),
            "status": _decode("o_orderstatus", ORDER_STATUS),
            "gender": F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("M"),
            "created_at": created,
            "returned_at": F.lit(None).cast("timestamp"),
            "shipped_at": F.when(status.isin("F", "P"), _later(created, 24)),
            "delivered_at": F.when(status == "F", _later(created, 96)),
            "num_of_item": F.coalesce(F.col("_items"), F.lit(0)),
        }
        return orders.select(*(derived[c].alias(c) for c in wanted))

    def order_items(
        self, columns: Collection[str] | None = None, since: datetime | None = None
    ) -> DataFrame:
        wanted = LANDINGS["order_items"].columns if columns is None else list(columns)
        items = self.table("lineitem").filter(_at_or_after("l_shipdate", since, timedelta(hours=ITEM_DELAY_HOURS)))
        if "user_id" in wanted:
            owner = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
            items = items.join(owner, "l_orderkey", "left")
        created = _later(F.col("l_shipdate").cast("timestamp"), ITEM_DELAY_HOURS)
        delivered = _later(created, F.col("l_quantity"))
        derived = {
            "id": _line_id(),
            "order_id": F.col("l_orderkey"),
            "user_id": F.col("o_custkey"),
            "product_id": F.col("l_partkey"),
            "inventory_item_id": F.col("l_suppkey"),
            "status": _decode("l_returnflag", ITEM_STATUS),
            "created_at": created,
            "shipped_at": _later(created, 1),
            "delivered_at": F.when(F.col("l_linestatus") == "F", delivered),
            "returned_at": F.when(F.col("l_returnflag") == "R", _later(created, 240)),
            "sale_price": F.col("l_extendedprice"),
        }
        return items.select(*(derived[c].alias(c) for c in wanted))

    def events(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
