"""Registry of landing tables: columns, primary key, cursor, how they are loaded."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from martweave.operators.ingest import since

# Fixed value: where the first load of an event table starts. It lies a quarter
# before the analysis horizon, for orders that close late.
BACKFILL_START = datetime(2022, 10, 1, tzinfo=timezone.utc)


@dataclass(frozen=True)
class Landing:
    """One landing table. Without a cursor it is replaced whole by each load.

    ``month_is_fixed``: a row keeps its cursor value for good, so an older version of
    it lies in the month of the newer one.
    """

    source: str
    table: str
    ddl: str
    keys: tuple[str, ...]
    cursor: str | None = None
    month_is_fixed: bool = False

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.ddl.split(",")]


# Landing columns and types.
LANDINGS = {
    t.table: t
    for t in (
        Landing(
            "crm",
            "users",
            "id bigint, first_name string, last_name string, email string, age bigint, "
            "gender string, state string, street_address string, postal_code string, "
            "city string, country string, latitude double, longitude double, "
            "traffic_source string, created_at timestamp",
            keys=("id",),
        ),
        Landing(
            "catalogue",
            "products",
            "id bigint, cost double, category string, name string, brand string, "
            "retail_price double, department string, sku string, distribution_center_id bigint",
            keys=("id",),
        ),
        Landing(
            "shop",
            "orders",
            "order_id bigint, user_id bigint, status string, gender string, "
            "created_at timestamp, returned_at timestamp, shipped_at timestamp, "
            "delivered_at timestamp, num_of_item bigint",
            keys=("order_id",),
            cursor="created_at",
            month_is_fixed=True,
        ),
        Landing(
            "shop",
            "order_items",
            "id bigint, order_id bigint, user_id bigint, product_id bigint, "
            "inventory_item_id bigint, status string, created_at timestamp, "
            "shipped_at timestamp, delivered_at timestamp, returned_at timestamp, "
            "sale_price double",
            keys=("id",),
            cursor="created_at",
            month_is_fixed=True,
        ),
    )
}


class Registry:
    """Maps a logical (source, table) to the place its files are."""

    def __init__(self, spark: SparkSession, places: dict[tuple[str, str], str], fmt: str = "parquet"):
        self.spark = spark
        self.places = dict(places)
        self.fmt = fmt

    def read(self, source: str, table: str, start: datetime | None = None) -> DataFrame:
        """The table under its declared schema, which is never inferred, from a cursor value on."""
        landing = LANDINGS[table]
        if landing.source != source or (source, table) not in self.places:
            raise KeyError(f"no source {source}.{table}")
        rows = self.spark.read.format(self.fmt).schema(landing.ddl).load(self.places[source, table])
        return rows if start is None or landing.cursor is None else since(rows, start, landing.cursor)
