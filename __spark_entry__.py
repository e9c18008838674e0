"""Registered queries over the given tables, each with its SQL counterpart.

Timestamps are shown as text so that both sides print them alike.
"""

from __future__ import annotations

import importlib.util
import sys
from collections.abc import Callable, Collection
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle as o  # noqa: E402
from martweave import session  # noqa: E402
from martweave.functions.audit import Run  # noqa: E402
from martweave.functions.privacy import pseudonymise, salt_column  # noqa: E402
from martweave.operators import contracts, dimensions, facts, ingest, metrics, quality, staging  # noqa: E402
from martweave.plans.build import Inputs, TestsFailed, build, lazy_models, mart  # noqa: E402
from martweave.plans.ingest_run import has_failed, landed, run_ingest  # noqa: E402
from martweave.sources.landed import LandedTable  # noqa: E402
from martweave.sources.tpch import LANDED, OrderTables  # noqa: E402
from martweave.streaming.ingest import file_stream, stream_into  # noqa: E402

UTC = timezone.utc
HORIZON = date(1996, 1, 1)
HORIZON_AT = datetime(1996, 1, 1, tzinfo=UTC)
FIRST_LOAD = datetime(1995, 10, 1, tzinfo=UTC)
ALL_HISTORY = datetime(1990, 1, 1, tzinfo=UTC)
CALENDAR_END = date(2002, 7, 1)
CLOCK = datetime(2001, 12, 1, 12, tzinfo=UTC)
RUN = Run(o.RUN_ID, datetime(2002, 1, 1, tzinfo=UTC))

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_PLAIN: dict[str, Query] = {}
_SQL: dict[str, str] = {}


class Context:
    """The given tables of one folder as landing tables and models."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = session.configure(spark)
        self.folder = folder
        self.tables = OrderTables(spark, folder)

    @property
    def salt(self):
        return salt_column(self.spark, o.SALT)

    def items(self, *staged: str) -> DataFrame:
        """Staged items inside the horizon; only what the named columns take is read."""
        landed_name = staging.RENAMED["stg_order_items"]
        columns = {landed_name.get(c, c) for c in staged} | {"created_at"}
        raw = self.tables.order_items(columns if staged else None, since=HORIZON_AT)
        return staging.stg_order_items(raw, RUN, HORIZON, only=list(staged) or None)

    def users(self) -> DataFrame:
        return dimensions.dim_users(staging.stg_users(self.tables.users(), RUN, self.salt), RUN)

    def products(self) -> DataFrame:
        return dimensions.dim_products(staging.stg_products(self.tables.products(), RUN), RUN)

    def orders(self) -> DataFrame:
        return staging.stg_orders(self.tables.orders(), RUN)

    def measured_items(self, *also: str) -> DataFrame:
        """Items with all measures, and no join for columns nobody asked for."""
        needed = ("order_id", "product_id", "status", "sale_price", "ordered_at", "delivered_at")
        return facts.item_measures(self.items(*needed, *also), self.products())

    def order_fact(self) -> DataFrame:
        return facts.fct_orders(self.measured_items(), self.orders(), RUN)

    def models(self, *wanted: str, joined: Collection[str] = ("user_id", "num_of_item")) -> dict[str, DataFrame]:
        """Models as plans. A user of an item and an item count of an order take a join
        each; those not in ``joined`` are left NULL, for tests that do not look at them."""
        costly = {"order_items": "user_id", "orders": "num_of_item"}

        def raw(table: str) -> DataFrame:
            since = {"since": HORIZON_AT} if table == "order_items" else {}
            left_out = costly.get(table)
            if left_out is None or left_out in joined:
                return getattr(self.tables, table)(**since)
            columns = LANDED[table].columns
            rows = getattr(self.tables, table)([c for c in columns if c != left_out], **since)
            return rows.withColumn(left_out, F.lit(None).cast("bigint")).select(*columns)

        inputs = Inputs(self.spark, raw, RUN, self.salt, HORIZON, CALENDAR_END)
        made = lazy_models(inputs, wanted)
        if "dim_dates" in made:
            made["dim_dates"] = self.data_calendar()
        return made

    def data_calendar(self, *days: str) -> DataFrame:
        """The calendar over the days the items themselves span, in the columns named or all."""
        columns = {"ordered_date": "ordered_at", "delivered_date": "delivered_at"}
        days = days or tuple(columns)
        dated = self.items(*(columns[d] for d in days)).select(*(F.to_date(columns[d]).alias(d) for d in days))
        return dimensions.dim_dates(dimensions.spine_over(dated, *days))

    def order_calendar(self) -> DataFrame:
        """The calendar from the horizon to the last day an order was placed."""
        placed = self.tables.orders(["created_at"]).select(F.to_date("created_at").alias("day"))
        start = self.spark.range(1).select(F.lit(HORIZON).alias("day"))
        spine = dimensions.spine_over(placed.unionByName(start), "day").filter(F.col("date_day") >= F.lit(HORIZON))
        return dimensions.dim_dates(spine)


def query(sql: str | None = None):
    def register(make: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
        name = make.__name__

        def plain(spark: SparkSession, folder: str) -> DataFrame:
            return make(Context(spark, folder))

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return shown(plain(spark, folder))

        _PLAIN[name] = plain
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return make

    return register


def shown(df: DataFrame) -> DataFrame:
    return df.select(
        *(
            F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
            if kind.startswith("timestamp")
            else F.col(name)
            for name, kind in df.dtypes
        )
    )


def without_audit(df: DataFrame) -> DataFrame:
    return df.drop("_loaded_at", "_run_id")


def union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- ingest ---------------------------------------------------------------


@query(o.sql(f"SELECT {o.landing_columns('users')} FROM land_users", "land_users"))
def ingest_users_snapshot(c: Context) -> DataFrame:
    return c.tables.users()


@query(o.sql(f"SELECT {o.landing_columns('products')} FROM land_products", "land_products"))
def ingest_products_snapshot(c: Context) -> DataFrame:
    return c.tables.products()


@query(
    o.sql(
        f"SELECT {o.landing_columns('orders')} FROM land_orders WHERE created_at >= {o.FIRST_LOAD}",
        "land_orders",
    )
)
def ingest_orders_incremental(c: Context) -> DataFrame:
    return ingest.since(c.tables.orders(since=FIRST_LOAD), FIRST_LOAD)


@query(
    o.sql(
        f"SELECT {o.landing_columns('orders')} FROM land_orders WHERE created_at >= {o.FIRST_LOAD}",
        "land_orders",
    )
)
def ingest_orders_by_marker(c: Context) -> DataFrame:
    """The bound as a parameter of fixed SQL text."""
    return ingest.since_by_marker(c.tables.orders(), FIRST_LOAD)


@query(
    o.sql(
        f"SELECT {o.landing_columns('order_items')} FROM land_order_items "
        f"WHERE created_at >= {o.FIRST_LOAD}",
        "land_order_items",
    )
)
def ingest_order_items_incremental(c: Context) -> DataFrame:
    return ingest.since(c.tables.order_items(since=FIRST_LOAD), FIRST_LOAD)


@query(
    o.sql(
        o.union(
            [
                f"SELECT '{t}' AS resource, {o.text('MAX(created_at)')} AS last_value FROM land_{t}"
                for t in ("orders", "order_items")
            ]
        ),
        "land_orders",
        "land_order_items",
    )
)
def cursor_high_watermark(c: Context) -> DataFrame:
    return union(
        ingest.high_watermark(df).withColumn("resource", F.lit(name))
        for name, df in (
            ("orders", c.tables.orders(["created_at"])),
            ("order_items", c.tables.order_items(["created_at"])),
        )
    )


_SPLIT = "TIMESTAMP '2024-01-15'", "TIMESTAMP '2024-01-20'"


@query(
    f"""
    WITH target AS (
        SELECT event_id, ts, user_id, event_type, value, 'load-1' AS _load_id
        FROM events WHERE ts < {_SPLIT[1]}
    ), batch AS (
        SELECT event_id, ts, user_id, event_type, value + n AS value, 'load-' || n AS _load_id
        FROM events, (VALUES (2), (3)) AS copies(n) WHERE ts >= {_SPLIT[0]}
    ), latest AS (
        SELECT * EXCLUDE (r) FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, _load_id DESC) AS r
            FROM batch) WHERE r = 1
    ), merged AS (
        SELECT * FROM target WHERE event_id NOT IN (SELECT event_id FROM latest)
        UNION ALL SELECT * FROM latest
    )
    SELECT event_id, {o.text('ts')} AS ts, user_id, event_type, value, _load_id FROM merged
    """
)
def merge_upsert(c: Context) -> DataFrame:
    """Two loads that overlap by five days; the second holds each key twice."""
    low, high = datetime(2024, 1, 15, tzinfo=UTC), datetime(2024, 1, 20, tzinfo=UTC)
    events = c.tables.events().select("event_id", "ts", "user_id", "event_type", "value")
    target = ingest.stamp_load(events.filter(F.col("ts") < high), "load-1")
    late = ingest.since(events, low, "ts")
    batch = union(
        ingest.stamp_load(late.withColumn("value", F.col("value") + n), f"load-{n}") for n in (2, 3)
    )
    latest = ingest.latest_per_key(batch, ["event_id"], ["ts", ingest.LOAD_ID])
    arriving = batch.select("event_id").dropDuplicates()
    return ingest.upsert(target, latest, ["event_id"], arriving)


@query(
    o.sql(
        f"""
        , seen AS (SELECT MAX(created_at) AS last_value FROM land_orders
                 WHERE created_at < TIMESTAMP '1999-01-01')
        SELECT order_id, user_id, gender, {o.text('created_at')} AS created_at, num_of_item,
               CASE WHEN late THEN 'Changed' ELSE status END AS status,
               CASE WHEN late THEN 'load-2' ELSE 'load-1' END AS _load_id
        FROM (SELECT *, created_at >= last_value - INTERVAL 90 DAY AS late
              FROM land_orders, seen)
        """,
        "land_orders",
    )
)
def landed_upsert(c: Context) -> DataFrame:
    """The same through stored tables: the second load starts 90 days behind the cursor."""
    landing = LANDED["orders"]
    table = landed(c.spark, session.work_folder(c.spark, "landed_upsert"), landing)
    orders = c.tables.orders()
    table.merge(
        orders.filter(F.col("created_at") < F.lit("1999-01-01").cast("timestamp")),
        "load-1",
        landing.cursor,
        landing.month_is_fixed,
    )
    changed = orders.withColumn("status", F.lit("Changed"))
    behind = timedelta(days=90)
    table.merge(
        ingest.since(changed, table.last_value(), landing.cursor, behind),
        "load-2",
        landing.cursor,
        landing.month_is_fixed,
    )
    return table.read().select(
        "order_id", "user_id", "gender", "created_at", "num_of_item", "status", ingest.LOAD_ID
    )


@query(
    f"""
    SELECT event_id, {o.text('ts')} AS ts, user_id, event_type, value, props
    FROM events
    """
)
def ingest_stream(c: Context) -> DataFrame:
    """Events taken in by a stream that stops when it has seen all there is."""
    folder = session.work_folder(c.spark, "ingest_stream")
    ddl = (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    )
    table = LandedTable(c.spark, f"{folder}/events", ddl, ["event_id"], month_of="ts")
    stream_into(
        file_stream(c.spark, f"{c.folder}/events.parquet", ddl),
        table,
        f"{folder}/checkpoint",
        cursor="ts",
        name="events",
        month_is_fixed=True,
    ).awaitTermination()
    return table.read().drop(ingest.LOAD_ID)


@query(
    o.sql(
        o.union(
            [
                "SELECT 'users' AS \"table\", 'loaded' AS status, COUNT(*) AS rows, "
                "CAST(NULL AS VARCHAR) AS last_value FROM land_users",
                "SELECT 'products', 'loaded', COUNT(*), NULL FROM land_products",
                f"SELECT 'orders', 'loaded', COUNT(*), {o.text('MAX(created_at)')} "
                f"FROM land_orders WHERE created_at >= {o.FIRST_LOAD}",
                f"SELECT 'order_items', 'loaded', COUNT(*), {o.text('MAX(created_at)')} "
                f"FROM land_order_items WHERE created_at >= {o.FIRST_LOAD}",
            ]
        ),
        "land_users",
        "land_products",
        "land_orders",
        "land_order_items",
    )
)
def ingest_run(c: Context) -> DataFrame:
    """One whole ingest run into stored landing tables, and its report."""
    report = run_ingest(
        c.spark,
        c.tables.read,
        session.work_folder(c.spark, "ingest_run"),
        "load-1",
        FIRST_LOAD,
        landings=LANDED,
    )
    return report.select("table", "status", "rows", "last_value")


@query(
    o.sql(
        o.union(
            [
                "SELECT 'users' AS \"table\", COUNT(*) AS rows, "
                f"{o.text('MIN(created_at)')} AS first_cursor, "
                f"{o.text('MAX(created_at)')} AS last_cursor FROM land_users",
                "SELECT 'products', COUNT(*), NULL, NULL FROM land_products",
                *(
                    f"SELECT '{t}', COUNT(*), {o.text('MIN(created_at)')}, "
                    f"{o.text('MAX(created_at)')} FROM land_{t} WHERE created_at >= {o.FIRST_LOAD}"
                    for t in ("orders", "order_items")
                ),
            ]
        ),
        "land_users",
        "land_products",
        "land_orders",
        "land_order_items",
    )
)
def load_report(c: Context) -> DataFrame:
    return ingest.load_report(
        {
            "users": (c.tables.users(), "created_at"),
            "products": (c.tables.products(), None),
            "orders": (
                ingest.since(c.tables.orders(["created_at"], FIRST_LOAD), FIRST_LOAD),
                "created_at",
            ),
            "order_items": (
                ingest.since(c.tables.order_items(["created_at"], FIRST_LOAD), FIRST_LOAD),
                "created_at",
            ),
        }
    )


def monthly_loads(df: DataFrame) -> DataFrame:
    return ingest.stamp_load(df, F.date_format("created_at", "'load-'yyyyMM"))


_MONTHLY = "'load-' || strftime(created_at, '%Y%m')"


@query(
    o.sql(
        o.union(
            [
                f"SELECT '{t}' AS \"table\", COUNT(*) AS rows, MIN({load}) AS first_load_id, "
                f"MAX({load}) AS last_load_id FROM land_{t}"
                for t, load in (
                    ("users", _MONTHLY),
                    ("products", "'load-1'"),
                    ("orders", _MONTHLY),
                    ("order_items", _MONTHLY),
                )
            ]
        ),
        "land_users",
        "land_products",
        "land_orders",
        "land_order_items",
    )
)
def load_id_audit(c: Context) -> DataFrame:
    t = c.tables
    stamped = {
        "users": monthly_loads(t.users()),
        "products": ingest.stamp_load(t.products(), "load-1"),
        "orders": monthly_loads(t.orders(["created_at"])),
        "order_items": monthly_loads(t.order_items(["created_at"])),
    }
    return union(ingest.load_audit(df, name) for name, df in stamped.items())


@query(
    o.sql(
        "SELECT *, lag(rows) OVER w AS rows_before, rows - lag(rows) OVER w AS change FROM ("
        + o.union(
            [
                f"SELECT '{t}' AS \"table\", {_MONTHLY} AS load_id, COUNT(*) AS rows "
                f"FROM land_{t} GROUP BY ALL"
                for t in ("orders", "order_items")
            ]
        )
        + ') WINDOW w AS (PARTITION BY "table" ORDER BY load_id)',
        "land_orders",
        "land_order_items",
    )
)
def load_volume(c: Context) -> DataFrame:
    return union(
        ingest.load_volume(monthly_loads(df), name)
        for name, df in (
            ("orders", c.tables.orders(["created_at"])),
            ("order_items", c.tables.order_items(["created_at"])),
        )
    )


_ODD_MONTH = date(1995, 6, 1)


@query(
    o.sql(
        """
        , loads AS (
            SELECT 'load-' || strftime(created_at, '%Y%m') AS load_id,
                   SUM(CASE WHEN strftime(created_at, '%Y%m') = '199506' THEN 3 ELSE 1 END)::BIGINT AS rows
            FROM land_order_items GROUP BY 1
        ), seen AS (
            SELECT *, coalesce(list(rows) OVER (ORDER BY load_id ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING), []) AS b
            FROM loads
        ), med AS (SELECT *, list_aggregate(b, 'median') AS usual_rows FROM seen),
        dev AS (SELECT *, list_aggregate(list_transform(b, lambda x: abs(x - usual_rows)), 'median') AS deviation FROM med)
        SELECT 'order_items' AS "table", load_id, rows, usual_rows, deviation,
               CASE WHEN len(b) < 5 THEN 'new'
                    WHEN abs(rows - usual_rows) > greatest(5 * 1.4826 * deviation, 0.5 * usual_rows) THEN 'abnormal'
                    ELSE 'normal' END AS status
        FROM dev
        """,
        "land_order_items",
    )
)
def load_monitor(c: Context) -> DataFrame:
    """Monthly loads, one of which came three times over, against the twelve before each."""
    items = c.tables.order_items(["created_at"])
    odd = items.filter(F.trunc("created_at", "month") == F.lit(_ODD_MONTH))
    loads = monthly_loads(union([items, odd, odd])).groupBy(F.col(ingest.LOAD_ID).alias("load_id"))
    rows = loads.agg(F.count(F.lit(1)).alias("rows"))
    return ingest.load_monitor(rows, "order_items", ingest.VolumeRule(loads=12))


@query(
    o.sql(
        "SELECT \"table\", "
        + o.text("newest")
        + " AS newest, CAST(floor(age / 3600.0) AS BIGINT) AS age_hours, "
        "CASE WHEN age IS NULL OR age > 365 * 86400 THEN 'error' WHEN age > 30 * 86400 "
        "THEN 'warn' ELSE 'pass' END AS status FROM ("
        f"SELECT *, trunc(epoch({o.CLOCK}) - epoch(newest)) AS age FROM ("
        + o.union(
            [
                f"SELECT '{t}' AS \"table\", MAX({column}) AS newest FROM {source}"
                for t, source, column in (
                    ("users", "land_users", "created_at"),
                    ("orders", "land_orders", "created_at"),
                    ("order_items", "land_order_items", "created_at"),
                    ("events", "events", "ts"),
                )
            ]
        )
        + "))",
        "land_users",
        "land_orders",
        "land_order_items",
    )
)
def source_freshness(c: Context) -> DataFrame:
    t = c.tables
    sources = (
        ("users", t.users(), "created_at"),
        ("orders", t.orders(["created_at"]), "created_at"),
        ("order_items", t.order_items(["created_at"]), "created_at"),
        ("events", t.events(), "ts"),
    )
    limits = timedelta(days=30), timedelta(days=365)
    return union(ingest.freshness(df, name, col, CLOCK, *limits) for name, df, col in sources)


# --- staging --------------------------------------------------------------


@query(o.rows_of("stg_users"))
def stg_users(c: Context) -> DataFrame:
    return without_audit(staging.stg_users(c.tables.users(), RUN, c.salt))


@query(o.rows_of("stg_products"))
def stg_products(c: Context) -> DataFrame:
    return without_audit(staging.stg_products(c.tables.products(), RUN))


@query(o.rows_of("stg_orders"))
def stg_orders(c: Context) -> DataFrame:
    return without_audit(c.orders())


@query(o.rows_of("stg_order_items"))
def stg_order_items(c: Context) -> DataFrame:
    return without_audit(c.items())


@query(
    o.sql(
        "SELECT id, CAST(created_at AS DATE) AS created_date FROM land_order_items "
        f"WHERE created_at >= {o.HORIZON}",
        "land_order_items",
    )
)
def horizon_filter(c: Context) -> DataFrame:
    raw = c.tables.order_items(["id", "created_at"], since=HORIZON_AT)
    return staging.within_horizon(raw, HORIZON).select(
        "id", F.to_date("created_at").alias("created_date")
    )


@query(
    o.sql(
        f"SELECT id, {o.hashed('email')} AS email, {o.hashed('last_name')} AS last_name FROM land_users",
        "land_users",
    )
)
def pseudonymised(c: Context) -> DataFrame:
    salt = c.salt
    return c.tables.users().select(
        "id",
        pseudonymise("email", salt).alias("email"),
        pseudonymise("last_name", salt).alias("last_name"),
    )


@query(
    o.sql(
        """
        SELECT u.user_id, u.email, c_acctbal AS balance
        FROM stg_users u JOIN customer
          ON u.email = sha256(c_name || '@example.com' || '%s')
        """
        % o.SALT,
        "stg_users",
    )
)
def pseudonymised_join(c: Context) -> DataFrame:
    """Another table hashed with the same salt meets the users on the hash."""
    salt = c.salt
    other = c.tables.table("customer").select(
        pseudonymise(F.concat("c_name", F.lit("@example.com")), salt).alias("email"),
        F.col("c_acctbal").alias("balance"),
    )
    users = staging.stg_users(c.tables.users(), RUN, salt)
    return users.select("user_id", "email").join(other, "email")


@query(
    o.sql(
        f"SELECT product_id, '{o.LOADED_AT}' AS _loaded_at, '{o.RUN_ID}' AS _run_id FROM dim_products",
        "dim_products",
    )
)
def audit_columns(c: Context) -> DataFrame:
    """Stamped by the run that builds the dimension, not by the one that staged."""
    staged = staging.stg_products(c.tables.products(), Run("run-0000", CLOCK))
    return dimensions.dim_products(staged, RUN).select("product_id", "_loaded_at", "_run_id")


# --- dimensions -----------------------------------------------------------


@query(o.rows_of("dim_users"))
def dim_users(c: Context) -> DataFrame:
    return without_audit(c.users())


@query(o.rows_of("dim_products"))
def dim_products(c: Context) -> DataFrame:
    return without_audit(c.products())


@query(
    o.sql(
        """
        SELECT date_day, COUNT(order_item_id) AS items_ordered
        FROM spine LEFT JOIN stg_order_items ON CAST(ordered_at AS DATE) = date_day
        GROUP BY date_day
        """,
        "spine",
        "stg_order_items",
    )
)
def date_spine(c: Context) -> DataFrame:
    """Every day the items span, with the items ordered on it, none included."""
    dated = facts.with_dates(c.items("ordered_at", "delivered_at"))
    per_day = dated.groupBy(F.col("ordered_date").alias("date_day")).agg(
        F.count(F.lit(1)).alias("items")
    )
    spine = dimensions.spine_over(dated, "ordered_date", "delivered_date")
    return spine.join(per_day, "date_day", "left").select(
        "date_day", F.coalesce("items", F.lit(0)).alias("items_ordered")
    )


@query(o.rows_of("dim_dates"))
def dim_dates(c: Context) -> DataFrame:
    return c.data_calendar()


# --- facts ----------------------------------------------------------------


@query(o.rows_of("fct_order_items"))
def fct_order_items(c: Context) -> DataFrame:
    return without_audit(facts.fct_order_items(c.items(), c.products(), RUN))


@query(o.rows_of("fct_order_items", ["order_item_id", "product_id", "cost"]))
def join_left_cost(c: Context) -> DataFrame:
    return facts.with_cost(c.items("order_item_id", "product_id"), c.products()).select(
        "order_item_id", "product_id", "cost"
    )


@query(o.rows_of("fct_order_items", ["order_item_id", "status", "net_revenue"]))
def net_revenue(c: Context) -> DataFrame:
    return facts.with_net_revenue(c.items("order_item_id", "status", "sale_price")).select(
        "order_item_id", "status", "net_revenue"
    )


@query(o.rows_of("fct_order_items", ["order_item_id", "gross_margin"]))
def gross_margin(c: Context) -> DataFrame:
    return c.measured_items("order_item_id").select("order_item_id", "gross_margin")


@query(o.rows_of("fct_order_items", ["order_item_id", "gross_margin_rate"]))
def gross_margin_rate(c: Context) -> DataFrame:
    return c.measured_items("order_item_id").select("order_item_id", "gross_margin_rate")


@query(o.rows_of("fct_order_items", ["order_item_id", "is_returned", "is_delivered"]))
def item_flags(c: Context) -> DataFrame:
    return facts.with_item_flags(c.items("order_item_id", "status", "delivered_at")).select(
        "order_item_id", "is_returned", "is_delivered"
    )


@query(o.rows_of("fct_order_items", ["order_item_id", "days_to_delivery"]))
def days_to_delivery(c: Context) -> DataFrame:
    dated = c.items("order_item_id", "ordered_at", "delivered_at")
    return facts.with_days_to_delivery(dated).select("order_item_id", "days_to_delivery")


@query(o.sql("SELECT * FROM order_totals", "order_totals"))
def agg_order(c: Context) -> DataFrame:
    return facts.order_totals(c.measured_items())


@query(
    o.sql(
        "SELECT order_id, is_fully_returned, is_partially_returned FROM order_flags", "order_flags"
    )
)
def order_return_flags(c: Context) -> DataFrame:
    totals = facts.order_totals(c.measured_items())
    return facts.with_return_flags(totals).select(
        "order_id", "is_fully_returned", "is_partially_returned"
    )


@query(o.sql("SELECT order_id, gross_margin_rate FROM order_flags", "order_flags"))
def order_margin_rate(c: Context) -> DataFrame:
    totals = facts.order_totals(c.measured_items())
    return facts.with_order_margin_rate(totals).select("order_id", "gross_margin_rate")


@query(o.rows_of("fct_orders", ["order_id", "user_id", "items_count", "status", "ordered_date"]))
def join_inner_orders(c: Context) -> DataFrame:
    counts = c.items("order_id").groupBy("order_id").agg(F.count(F.lit(1)).alias("items_count"))
    joined = facts.with_dates(facts.with_order_attributes(counts, c.orders()))
    return joined.select("order_id", "user_id", "items_count", "status", "ordered_date")


@query(o.rows_of("fct_orders"))
def fct_orders(c: Context) -> DataFrame:
    return without_audit(c.order_fact())


# --- quality --------------------------------------------------------------


def _models_sql(select: str) -> str:
    return o.sql(select, *o.COLUMNS)


@query(_models_sql(o.union(o.not_null_rows(quality.NOT_NULL))))
def dq_not_null(c: Context) -> DataFrame:
    """One pass over each model; only the item fact's test looks at an item's user."""
    return union(
        quality.not_null(c.models(m, joined=("user_id",) if m == "fct_order_items" else ())[m], m, cols)
        for m, cols in quality.NOT_NULL.items()
    )


@query(_models_sql(o.union(o.unique_rows(quality.UNIQUE.items()))))
def dq_unique(c: Context) -> DataFrame:
    return quality.uniques(c.models(*quality.UNIQUE, joined=()), list(quality.UNIQUE.items()))


_RELATIONSHIPS = (*quality.RELATIONSHIPS, *quality.DEFERRED_RELATIONSHIPS)


@query(
    _models_sql(
        o.union(o.relationship_rows((r.child, r.column, r.parent, r.field) for r in _RELATIONSHIPS))
    )
)
def dq_relationships(c: Context) -> DataFrame:
    """All tests together; an order's user needs no look at the items' users."""
    items = c.models("fct_order_items", "dim_products", joined=("user_id",))
    orders = c.models("fct_orders", "stg_orders", "stg_users", "dim_users", joined=())
    return quality.relationships(orders | items, _RELATIONSHIPS)


@query(
    o.sql(
        """
        SELECT 'order_items' AS model, 'id' AS "column", 'unique_in_load' AS test, COUNT(*) AS failures FROM (
            SELECT id FROM (
                SELECT id FROM land_order_items UNION ALL SELECT id FROM land_order_items WHERE id % 97 = 5)
            WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1 AND bool_or(id % 97 = 5))
        """,
        "land_order_items",
    )
)
def dq_unique_in_load(c: Context) -> DataFrame:
    """A load that brings some ids again, against all loads before it."""
    items = c.tables.order_items(["id", "created_at"])
    again = items.filter("id % 97 = 5").withColumn(ingest.LOAD_ID, F.lit("load-again"))
    return quality.unique_in_load(monthly_loads(items).unionByName(again), "order_items", "id", "load-again")


@query(
    _models_sql(
        o.union(
            [
                f"SELECT '{m}' AS model, '{col}' AS \"column\", {col} AS value, COUNT(*) AS rows, "
                f"{col} IN ({', '.join(repr(v) for v in values)}) AS accepted "
                f"FROM {m} WHERE {col} IS NOT NULL GROUP BY {col}"
                for (m, col), values in quality.ACCEPTED_VALUES.items()
            ]
        )
    )
)
def dq_accepted_values(c: Context) -> DataFrame:
    models = c.models(*(m for m, _ in quality.ACCEPTED_VALUES), joined=())
    return union(
        quality.value_counts(models[m], m, col, values)
        for (m, col), values in quality.ACCEPTED_VALUES.items()
    )


@query(
    _models_sql(
        "SELECT * FROM ("
        + o.union(
            [
                *o.not_null_rows(quality.DEFERRED_NOT_NULL),
                *o.unique_rows(quality.DEFERRED_UNIQUE),
            ]
        )
        + ")"
    )
)
def dq_deferred(c: Context) -> DataFrame:
    """Tests that are named but only warn: addresses and stock codes."""
    models = c.models("stg_users", "stg_products", "dim_products")
    soft = [quality.not_null(models[m], m, cols) for m, cols in quality.DEFERRED_NOT_NULL.items()]
    soft += [quality.unique(models[m], m, col) for m, col in quality.DEFERRED_UNIQUE]
    return union(soft)


_ORPHANS = f"""
    FROM fct_order_items i WHERE order_id NOT IN
        (SELECT order_id FROM land_orders WHERE created_at >= {o.FIRST_LOAD})
"""


@query(
    o.sql(
        f"SELECT order_id, COUNT(*) AS rows {_ORPHANS} GROUP BY order_id",
        "fct_order_items",
        "land_orders",
    )
)
def fk_orphans(c: Context) -> DataFrame:
    """Items whose order was placed before the first load and so never landed."""
    landed_orders = ingest.since(c.tables.orders(["order_id", "created_at"], FIRST_LOAD), FIRST_LOAD)
    return quality.orphans(c.items("order_id"), "order_id", landed_orders, "order_id")


@query(
    o.sql(
        "SELECT ordered_date, COUNT(DISTINCT order_id) AS orphan_keys, COUNT(*) AS orphan_rows "
        f"{_ORPHANS} GROUP BY ordered_date",
        "fct_order_items",
        "land_orders",
    )
)
def orphans_by_day(c: Context) -> DataFrame:
    landed_orders = ingest.since(c.tables.orders(["order_id", "created_at"], FIRST_LOAD), FIRST_LOAD)
    items = c.items("order_id", "ordered_at").withColumn("ordered_date", F.to_date("ordered_at"))
    return quality.orphans_by_day(items, "order_id", landed_orders, "order_id", "ordered_date")


@query(
    _models_sql(
        o.union(
            [
                f"SELECT '{m}' AS model, '{col}' AS \"column\", "
                f"'{o.TYPES.get(col, 'string')}' AS declared_type, "
                f"'{o.TYPES.get(col, 'string')}' AS actual_type, TRUE AS matches, "
                f"COUNT(*) AS rows, COUNT(*) - COUNT({col}) AS nulls FROM {m}"
                for m, columns in o.COLUMNS.items()
                for col in columns
            ]
            + [
                f"SELECT '{m}', '{col}', '{kind}', '{kind}', TRUE, COUNT(*), 0 FROM {m}"
                for m in o.COLUMNS
                if m != "dim_dates"
                for col, kind in (("_loaded_at", "timestamp"), ("_run_id", "string"))
            ]
        )
    )
)
def contract_report(c: Context) -> DataFrame:
    """One pass over each model; an item's user comes into no column of an order."""
    others = [m for m in contracts.CONTRACTS if m != "fct_orders"]
    models = c.models(*others) | {"fct_orders": c.models("fct_orders", joined=())["fct_orders"]}
    return union(contracts.contract_report(models[m], m) for m in contracts.CONTRACTS)


@query(
    o.rows_of(
        "dim_users",
        [x for x in o.USERS if x not in {"first_name", "last_name", "email", "street_address"}],
    )
)
def classified_projection(c: Context) -> DataFrame:
    return contracts.visible_to(contracts.classify(c.users(), "dim_users"), {"public"})


@query(
    o.sql(
        """
        SELECT country, COUNT(*) AS users, MIN(age) AS youngest FROM dim_users GROUP BY country
        """,
        "dim_users",
    )
)
def classified_derived(c: Context) -> DataFrame:
    """Of columns derived from classed ones only those that come from public columns alone."""
    users = contracts.classify(c.users(), "dim_users")
    derived = users.withColumn("contact", F.concat_ws(" ", "email", "city")).groupBy("country").agg(
        F.count(F.lit(1)).alias("users"),
        F.min("age").alias("youngest"),
        F.max("contact").alias("a_contact"),
        F.collect_set("last_name").alias("names"),
    )
    return contracts.visible_to(contracts.inherit(derived), {"public"})


# --- metrics --------------------------------------------------------------


def by_month(c: Context, key: str = "ordered_date") -> metrics.Lookup:
    return metrics.Lookup(c.data_calendar(key), key, "date_day", ("year_month",), calendar=True)


@query(
    o.sql(
        f"""
        SELECT strftime(ordered_date, '%Y-%m') AS year_month, {o.money('net_revenue')} AS net_revenue,
               COUNT(*) AS items
        FROM fct_order_items GROUP BY 1
        """,
        "fct_order_items",
    )
)
def metric_net_revenue_by_month(c: Context) -> DataFrame:
    items = facts.with_net_revenue(c.items("status", "sale_price", "ordered_at"))
    dated = items.withColumn("ordered_date", F.to_date("ordered_at"))
    return metrics.measure(
        dated, "fct_order_items", ["net_revenue", "items"], ["year_month"], (by_month(c),)
    )


@query(
    o.sql(
        f"""
        SELECT brand, {o.money('gross_margin')} AS gross_margin
        FROM fct_order_items i LEFT JOIN dim_products p ON p.product_id = i.product_id
        GROUP BY brand
        """,
        "fct_order_items",
        "dim_products",
    )
)
def metric_margin_by_brand(c: Context) -> DataFrame:
    brands = metrics.Lookup(c.products(), "product_id", "product_id", ("brand",))
    return metrics.measure(
        c.measured_items(), "fct_order_items", ["gross_margin"], ["brand"], (brands,)
    )


@query(
    o.sql(
        f"""
        SELECT traffic_source, {o.money('total_revenue_net')} / COUNT(*) AS avg_order_value,
               COUNT(*) AS orders
        FROM fct_orders f LEFT JOIN dim_users u ON u.user_id = f.user_id GROUP BY traffic_source
        """,
        "fct_orders",
        "dim_users",
    )
)
def metric_aov_by_segment(c: Context) -> DataFrame:
    segments = metrics.Lookup(c.users(), "user_id", "user_id", ("traffic_source",))
    return metrics.measure(
        c.order_fact(),
        "fct_orders",
        ["avg_order_value", "orders"],
        ["traffic_source"],
        (segments,),
    )


@query(
    o.sql(
        """
        SELECT category, CAST(COUNT(*) FILTER (WHERE is_returned) AS DOUBLE) / COUNT(*) AS return_rate
        FROM fct_order_items i LEFT JOIN dim_products p ON p.product_id = i.product_id
        GROUP BY category
        """,
        "fct_order_items",
        "dim_products",
    )
)
def metric_return_rate(c: Context) -> DataFrame:
    flagged = facts.with_item_flags(c.items("product_id", "status", "delivered_at"))
    category = metrics.Lookup(c.products(), "product_id", "product_id", ("category",))
    return metrics.measure(flagged, "fct_order_items", ["return_rate"], ["category"], (category,))


@query(
    o.sql(
        """
        SELECT strftime(ordered_date, '%Y-%m') AS year_month,
               COUNT(days_to_delivery) AS delivered_items,
               CAST(SUM(days_to_delivery) AS DOUBLE) / COUNT(days_to_delivery) AS avg_days,
               quantile_cont(days_to_delivery, 0.5) AS p50_days,
               quantile_cont(days_to_delivery, 0.9) AS p90_days
        FROM fct_order_items WHERE days_to_delivery IS NOT NULL GROUP BY 1
        """,
        "fct_order_items",
    )
)
def metric_delivery_days(c: Context) -> DataFrame:
    items = facts.with_days_to_delivery(c.items("ordered_at", "delivered_at"))
    monthly = items.withColumn("year_month", F.date_format("ordered_at", "yyyy-MM"))
    return metrics.delivery_days(monthly, ["year_month"])


@query(
    """
    SELECT CAST(ts AS DATE) AS day, COUNT(DISTINCT user_id) AS users,
           COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS converted_users,
           CAST(COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS DOUBLE)
               / COUNT(DISTINCT user_id) AS conversion_rate
    FROM events WHERE user_id IS NOT NULL GROUP BY 1
    """
)
def metric_conversion(c: Context) -> DataFrame:
    return metrics.conversion_rate(c.tables.events().withColumn("day", F.to_date("ts")), ["day"])


@query(
    o.sql(
        f"""
        SELECT country, COUNT(*) AS items, COUNT(DISTINCT f.user_id) AS buyers,
               COUNT(days_to_delivery) AS delivered_items, {o.money('net_revenue')} AS net_revenue,
               CAST(SUM(days_to_delivery) AS DOUBLE) / COUNT(days_to_delivery) AS avg_delivery_days,
               quantile_cont(days_to_delivery, 0.5) AS p50_delivery_days,
               quantile_cont(days_to_delivery, 0.9) AS p90_delivery_days
        FROM fct_order_items f LEFT JOIN dim_users u ON u.user_id = f.user_id GROUP BY country
        """,
        "fct_order_items",
        "dim_users",
    )
)
def metric_delivery_by_country(c: Context) -> DataFrame:
    """Sums, percentiles and different users side by side, over a dimension of the fact."""
    items = facts.item_measures(
        c.items("order_id", "product_id", "user_id", "status", "sale_price", "ordered_at", "delivered_at"), c.products()
    )
    country = metrics.Lookup(c.users(), "user_id", "user_id", ("country",))
    names = ["items", "buyers", "delivered_items", "net_revenue", "avg_delivery_days"]
    shares = ["p50_delivery_days", "p90_delivery_days"]
    return metrics.measure(items, "fct_order_items", names + shares, ["country"], (country,))


def _events_by_month(c: Context) -> DataFrame:
    return c.tables.events().withColumn("year_month", F.date_format("ts", "yyyy-MM"))


_USERS_BY = """
    FROM events e LEFT JOIN dim_users u ON u.user_id = e.user_id GROUP BY ALL
"""


@query(
    o.sql(
        f"""
        SELECT strftime(ts, '%Y-%m') AS year_month, country, COUNT(*) AS events,
               COUNT(DISTINCT e.user_id) AS users,
               COUNT(DISTINCT e.user_id) FILTER (WHERE event_type = 'purchase') AS converted_users,
               CAST(COUNT(DISTINCT e.user_id) FILTER (WHERE event_type = 'purchase') AS DOUBLE)
                   / nullif(COUNT(DISTINCT e.user_id), 0) AS conversion_rate
        {_USERS_BY}
        """,
        "dim_users",
    )
)
def metric_conversion_by_country(c: Context) -> DataFrame:
    country = metrics.Lookup(c.users(), "user_id", "user_id", ("country",))
    return metrics.measure(
        _events_by_month(c),
        "events",
        ["events", "users", "converted_users", "conversion_rate"],
        ["year_month", "country"],
        (country,),
    )


@query(
    o.sql(
        f"""
        SELECT country, COUNT(DISTINCT e.user_id) AS users, TRUE AS near
        {_USERS_BY}
        """,
        "dim_users",
    )
)
def metric_sketches(c: Context) -> DataFrame:
    """Different users counted exactly and from sketches merged over users' rows: within five standard errors."""
    country = metrics.Lookup(c.users(), "user_id", "user_id", ("country",))
    found = metrics.measure(c.tables.events(), "events", ["users", "users_sketched"], ["country"], (country,))
    error = 5 * 1.04 / 2 ** (metrics.SKETCH_LOG / 2)
    near = F.abs(F.col("users_sketched") - F.col("users")) <= F.greatest(F.lit(1.0), error * F.col("users"))
    return found.select("country", "users", near.alias("near"))


def _grains(c: Context) -> tuple[DataFrame, DataFrame]:
    names, by = ["net_revenue", "gross_margin", "items"], ["country"]
    country = metrics.Lookup(c.users(), "user_id", "user_id", ("country",))
    return (
        metrics.measure(c.measured_items("user_id"), "fct_order_items", names, by, (country,)),
        metrics.measure(c.order_fact(), "fct_orders", names, by, (country,)),
    )


_GRAIN_SQL = """
    SELECT country, {net} AS net_revenue, {margin} AS gross_margin,
           CAST({items} AS DOUBLE) AS items
    FROM {fact} f LEFT JOIN dim_users u ON u.user_id = f.user_id GROUP BY country
"""


@query(
    o.sql(
        ", a AS ("
        + _GRAIN_SQL.format(
            net=o.money("net_revenue"),
            margin=o.money("gross_margin"),
            items="COUNT(*)",
            fact="fct_order_items",
        )
        + "), b AS ("
        + _GRAIN_SQL.format(
            net=o.money("total_revenue_net"),
            margin=o.money("total_gross_margin"),
            items="SUM(items_count)",
            fact="fct_orders",
        )
        + ")"
        + o.union(
            [
                f"SELECT a.country, '{m}' AS metric, a.{m} AS left_value, b.{m} AS right_value, "
                f"abs(a.{m} - b.{m}) AS difference, a.{m} = b.{m} AS coherent "
                "FROM a JOIN b ON a.country = b.country"
                for m in ("net_revenue", "gross_margin", "items")
            ]
        ),
        "fct_order_items",
        "fct_orders",
        "dim_users",
    )
)
def metric_coherence(c: Context) -> DataFrame:
    """The same metrics on the item grain and on the order grain."""
    left, right = _grains(c)
    return metrics.coherence(left, right, ["country"], ["net_revenue", "gross_margin", "items"])


@query(
    o.sql(
        f"""
        SELECT strftime(ordered_date, '%Y-%m') AS year_month, country,
               {o.money('net_revenue')} AS net_revenue, {o.money('gross_margin')} AS gross_margin,
               COUNT(*) AS items
        FROM fct_order_items i LEFT JOIN dim_users u ON u.user_id = i.user_id GROUP BY 1, 2
        """,
        "fct_order_items",
        "dim_users",
    )
)
def star_month_country(c: Context) -> DataFrame:
    # A user buys little in a month: summing by both first would move nearly as many rows.
    country = metrics.Lookup(c.users(), "user_id", "user_id", ("country",), sum_first=False)
    return metrics.measure(
        c.measured_items("user_id"),
        "fct_order_items",
        ["net_revenue", "gross_margin", "items"],
        ["year_month", "country"],
        (by_month(c), country),
    )


@query(
    o.sql(
        f"""
        SELECT CASE WHEN ordered_date >= {o.HORIZON} THEN year(ordered_date) || '-Q'
                    || quarter(ordered_date) END AS year_quarter,
               status, {o.money('total_revenue_net')} AS net_revenue, COUNT(*) AS orders
        FROM fct_orders GROUP BY 1, 2
        """,
        "fct_orders",
    )
)
def star_quarter_status(c: Context) -> DataFrame:
    """Orders placed before the calendar starts are kept, under no quarter."""
    quarters = metrics.Lookup(
        c.order_calendar(), "ordered_date", "date_day", ("year_quarter",), calendar=True
    )
    return metrics.measure(
        c.order_fact(),
        "fct_orders",
        ["net_revenue", "orders"],
        ["year_quarter", "status"],
        (quarters,),
    )


@query(
    o.sql(
        f"""
        SELECT strftime(ordered_date, '%Y-%m') AS year_month, status, {o.money('net_revenue')} AS net_revenue,
               COUNT(*) AS items, quantile_cont(days_to_delivery, 0.9) AS p90_delivery_days
        FROM fct_order_items WHERE year(ordered_date) = 1997 AND quarter(ordered_date) = 2 GROUP BY 1, 2
        """,
        "fct_order_items",
    )
)
def star_stored_quarter(c: Context) -> DataFrame:
    """Over a stored fact: the filtered calendar decides which months are read."""
    models = c.models("fct_order_items", joined=())
    table = mart(c.spark, session.work_folder(c.spark, "star"), "fct_order_items")
    table.replace(contracts.enforce(models["fct_order_items"], "fct_order_items"), RUN.run_id)
    quarter = c.data_calendar("ordered_date").filter("year = 1997 AND quarter = 2")
    calendar = metrics.Lookup(
        quarter, "ordered_date", "date_day", ("year_month",), calendar=True, only=True, month="year_month"
    )
    return metrics.measure(
        table.by_month(),
        "fct_order_items",
        ["net_revenue", "items", "p90_delivery_days"],
        ["year_month", "status"],
        (calendar,),
    )


# --- the whole run --------------------------------------------------------

def _severity(rows: list[str], severity: str) -> list[str]:
    return [f"SELECT *, '{severity}' AS severity FROM ({r})" for r in rows]


_COHERENCE = [
    f"""
    SELECT 'fct_orders' AS model, '{name}' AS "column", 'coherence:fct_order_items' AS test,
           COUNT(*) FILTER (a.v IS DISTINCT FROM b.v) AS failures
    FROM (SELECT country, {of_items} AS v FROM fct_order_items f LEFT JOIN dim_users u ON u.user_id = f.user_id
          WHERE order_id IN (SELECT order_id FROM fct_orders) GROUP BY country) a
    FULL JOIN (SELECT country, {of_orders} AS v FROM fct_orders f LEFT JOIN dim_users u ON u.user_id = f.user_id
               GROUP BY country) b ON a.country IS NOT DISTINCT FROM b.country
    """
    for name, of_items, of_orders in (
        ("net_revenue", o.money("net_revenue"), o.money("total_revenue_net")),
        ("gross_margin", o.money("gross_margin"), o.money("total_gross_margin")),
        ("items", "COUNT(*)", "SUM(items_count)"),
    )
]

_TESTS_SQL = _models_sql(
    o.union(
        _severity(
            o.not_null_rows(quality.NOT_NULL)
            + o.unique_rows(quality.UNIQUE.items())
            + o.relationship_rows(
                (r.child, r.column, r.parent, r.field) for r in quality.RELATIONSHIPS
            )
            + _COHERENCE,
            "error",
        )
        + _severity(
            o.not_null_rows(quality.DEFERRED_NOT_NULL)
            + o.unique_rows(quality.DEFERRED_UNIQUE)
            + o.relationship_rows(
                (r.child, r.column, r.parent, r.field) for r in quality.DEFERRED_RELATIONSHIPS
            )
            + [
                o.row(
                    f"{m} WHERE {col} NOT IN ({', '.join(repr(v) for v in values)})",
                    m,
                    col,
                    "accepted_values",
                    "COUNT(*)",
                )
                for (m, col), values in quality.ACCEPTED_VALUES.items()
            ],
            "warn",
        )
    )
)


@query(_TESTS_SQL)
def build_run(c: Context) -> DataFrame:
    """Ingest all history, build every model into stored marts, run the declared tests."""
    folder = session.work_folder(c.spark, "build_run")
    report = run_ingest(c.spark, c.tables.read, f"{folder}/raw", "load-1", ALL_HISTORY, landings=LANDED)
    if has_failed(report):
        raise RuntimeError(f"ingest failed: {report.collect()}")

    def raw(table: str) -> DataFrame:
        return landed(c.spark, f"{folder}/raw", LANDED[table]).read()

    inputs = Inputs(c.spark, raw, RUN, c.salt, HORIZON, CALENDAR_END)
    return build(inputs, folder, deferred_tests=True, gate=False).tests


@query(
    o.sql(
        """
        SELECT 'dim_products' AS model, FALSE AS stored, COUNT(*) AS failures FROM (
            SELECT id FROM (SELECT id FROM land_products UNION ALL SELECT id FROM land_products WHERE id % 10 = 3)
            GROUP BY id HAVING COUNT(*) > 1)
        UNION ALL SELECT 'fct_order_items', FALSE, 0
        UNION ALL SELECT 'fct_orders', FALSE, 0
        """,
        "land_products",
    )
)
def build_gate(c: Context) -> DataFrame:
    """A build over a catalogue that lists some products twice stops there: what was stored, and why."""
    folder = session.work_folder(c.spark, "build_gate")

    def raw(table: str) -> DataFrame:
        rows = getattr(c.tables, table)(**({"since": HORIZON_AT} if table == "order_items" else {}))
        return rows.unionByName(rows.filter("id % 10 = 3")) if table == "products" else rows

    found: dict[str, int] = {}
    try:
        build(Inputs(c.spark, raw, RUN, c.salt, HORIZON, CALENDAR_END), folder)
    except TestsFailed as failed:
        found = {r.model: r.failures for r in failed.results if r.test == "unique" and r.failures}
    place = f"{folder}/analytics_marts"
    report = [
        (name, not mart(c.spark, place, name).is_new(), found.get(name.replace("dim_", "stg_"), 0))
        for name in ("dim_products", "fct_order_items", "fct_orders")
    ]
    return c.spark.createDataFrame(report, "model string, stored boolean, failures bigint")


# --- training data --------------------------------------------------------

# The operators of ``llm`` are registered where the subpackage is installed.
if all(map(importlib.util.find_spec, ("martweave.llm", "corpus_pipeline"))) and importlib.util.find_spec(
    "martweave.llm.queries"
):
    import corpus_pipeline  # noqa: E402
    from martweave.llm import queries as llm  # noqa: E402

    _QUERIES |= llm.QUERIES | {"pipeline": lambda s, d: corpus_pipeline.run(llm.shipped(s), d)}
    _SQL |= llm.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def plain_queries() -> dict[str, Query]:
    """The same without timestamps turned into text, which costs more than many a query."""
    return dict(_PLAIN)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def entry(spark: SparkSession) -> DataFrame:
    return _QUERIES["star_month_country"](spark, "/root/testdata/sf0.001")
