"""The registered queries as SQL over the given tables, for an independent check.

Landing tables and models are common table expressions; a query names those it
reads and gets the ones they need along with it.
"""

from __future__ import annotations

HORIZON = "TIMESTAMP '1996-01-01'"
FIRST_LOAD = "TIMESTAMP '1995-10-01'"
CLOCK = "TIMESTAMP '2001-12-01 12:00:00'"
SALT = "a-salt-for-tests"
RUN_ID = "run-0001"
LOADED_AT = "2002-01-01 00:00:00"


def money(amount: str) -> str:
    return f"CAST(SUM(CAST({amount} AS DECIMAL(18,4))) AS DOUBLE)"


def text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def hashed(column: str) -> str:
    return f"sha256({column} || '{SALT}')"


# Columns of the models.
USERS = (
    "user_id first_name last_name email street_address age gender state postal_code city "
    "country latitude longitude traffic_source registered_at"
).split()
PRODUCTS = (
    "product_id cost retail_price category name brand department sku distribution_center_id"
).split()
ORDERS = (
    "order_id user_id status gender num_of_item shipped_at delivered_at returned_at ordered_at"
).split()
ORDER_ITEMS = (
    "order_item_id order_id user_id product_id inventory_item_id status sale_price shipped_at "
    "delivered_at returned_at ordered_at"
).split()
DATES = (
    "date_day year quarter month day day_of_week day_of_year year_month year_quarter is_weekend"
).split()
FACT_ITEMS = (
    "order_item_id order_id user_id product_id inventory_item_id ordered_date delivered_date "
    "status sale_price cost ordered_at shipped_at delivered_at returned_at net_revenue "
    "gross_margin gross_margin_rate is_returned is_delivered days_to_delivery"
).split()
FACT_ORDERS = (
    "order_id user_id ordered_date delivered_date status gender ordered_at shipped_at "
    "delivered_at returned_at items_count returned_items_count is_fully_returned "
    "is_partially_returned total_revenue_gross total_revenue_net total_cost total_gross_margin "
    "gross_margin_rate average_item_price"
).split()
COLUMNS = {
    "stg_users": USERS,
    "stg_products": PRODUCTS,
    "stg_orders": ORDERS,
    "stg_order_items": ORDER_ITEMS,
    "dim_users": USERS,
    "dim_products": PRODUCTS,
    "dim_dates": DATES,
    "fct_order_items": FACT_ITEMS,
    "fct_orders": FACT_ORDERS,
}
TIMES = {"shipped_at", "delivered_at", "returned_at", "ordered_at", "registered_at", "created_at"}
TYPES = {
    **dict.fromkeys(
        "user_id age product_id distribution_center_id order_id num_of_item order_item_id "
        "inventory_item_id year quarter month day day_of_week day_of_year days_to_delivery "
        "items_count returned_items_count".split(),
        "bigint",
    ),
    **dict.fromkeys(
        "latitude longitude cost retail_price sale_price net_revenue gross_margin "
        "gross_margin_rate total_revenue_gross total_revenue_net total_cost total_gross_margin "
        "average_item_price".split(),
        "double",
    ),
    **dict.fromkeys(TIMES, "timestamp"),
    **dict.fromkeys("date_day ordered_date delivered_date".split(), "date"),
    **dict.fromkeys(
        "is_weekend is_returned is_delivered is_fully_returned is_partially_returned".split(),
        "boolean",
    ),
}

# name -> (what it reads, its rows)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "land_users": (
        (),
        """
        SELECT c_custkey AS id, c_name AS first_name, c_name AS last_name,
               CASE WHEN c_custkey % 10 <> 0 THEN c_name || '@example.com' END AS email,
               18 + c_custkey % 60 AS age,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               r_name AS state, c_name || ' street' AS street_address,
               CAST(NULL AS VARCHAR) AS postal_code, CAST(NULL AS VARCHAR) AS city,
               n_name AS country, CAST(NULL AS DOUBLE) AS latitude,
               CAST(NULL AS DOUBLE) AS longitude, c_mktsegment AS traffic_source,
               TIMESTAMP '1994-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at
        FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey
        """,
    ),
    "land_products": (
        (),
        """
        SELECT p_partkey AS id, CASE WHEN p_size % 10 <> 0 THEN p_retailprice END AS cost,
               p_type AS category, p_name AS name, p_brand AS brand,
               p_retailprice AS retail_price,
               CASE WHEN p_size % 2 = 0 THEN 'Women' ELSE 'Men' END AS department,
               'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
               CAST(p_size % 10 AS BIGINT) AS distribution_center_id
        FROM part
        """,
    ),
    "land_orders": (
        (),
        """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CASE o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'O' THEN 'Processing'
                                  WHEN 'P' THEN 'Shipped' END AS status,
               CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               o_orderdate AS created_at, CAST(NULL AS TIMESTAMP) AS returned_at,
               CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate + INTERVAL 1 DAY END AS shipped_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 4 DAY END AS delivered_at,
               COALESCE(n, 0) AS num_of_item
        FROM orders
        LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey)
          ON l_orderkey = o_orderkey
        """,
    ),
    "land_order_items": (
        (),
        """
        SELECT ((l_orderkey * 8 + l_linenumber) % 4294967296) * 2147483648
                   + (l_partkey * 100003 + l_suppkey) % 2147483647 AS id,
               l_orderkey AS order_id, o_custkey AS user_id, l_partkey AS product_id,
               l_suppkey AS inventory_item_id,
               CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Cancelled'
                                 WHEN 'N' THEN 'Complete' END AS status,
               l_shipdate + INTERVAL 23 HOUR AS created_at,
               l_shipdate + INTERVAL 24 HOUR AS shipped_at,
               CASE WHEN l_linestatus = 'F'
                    THEN l_shipdate + to_hours(CAST(23 + l_quantity AS INTEGER)) END AS delivered_at,
               CASE WHEN l_returnflag = 'R'
                    THEN l_shipdate + INTERVAL 23 HOUR + INTERVAL 10 DAY END AS returned_at,
               l_extendedprice AS sale_price
        FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
        """,
    ),
    "stg_users": (
        ("land_users",),
        f"""
        SELECT id AS user_id, {hashed('first_name')} AS first_name,
               {hashed('last_name')} AS last_name, {hashed('email')} AS email,
               {hashed('street_address')} AS street_address, age, gender, state, postal_code,
               city, country, latitude, longitude, traffic_source, created_at AS registered_at
        FROM land_users
        """,
    ),
    "stg_products": (
        ("land_products",),
        "SELECT * EXCLUDE (id), id AS product_id FROM land_products",
    ),
    "stg_orders": (
        ("land_orders",),
        "SELECT * EXCLUDE (created_at), created_at AS ordered_at FROM land_orders",
    ),
    "stg_order_items": (
        ("land_order_items",),
        f"""
        SELECT * EXCLUDE (id, created_at), id AS order_item_id, created_at AS ordered_at
        FROM land_order_items WHERE created_at >= {HORIZON}
        """,
    ),
    "dim_users": (("stg_users",), "SELECT * FROM stg_users"),
    "dim_products": (("stg_products",), "SELECT * FROM stg_products"),
    "spine": (
        ("stg_order_items",),
        """
        SELECT CAST(unnest(range(a, b + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date_day
        FROM (SELECT CAST(MIN(LEAST(ordered_at, delivered_at)) AS DATE) AS a,
                     CAST(MAX(GREATEST(ordered_at, delivered_at)) AS DATE) AS b
              FROM stg_order_items)
        """,
    ),
    "dim_dates": (
        ("spine",),
        """
        SELECT date_day, year(date_day) AS year, quarter(date_day) AS quarter,
               month(date_day) AS month, day(date_day) AS day,
               dayofweek(date_day) AS day_of_week, dayofyear(date_day) AS day_of_year,
               strftime(date_day, '%Y-%m') AS year_month,
               year(date_day) || '-Q' || quarter(date_day) AS year_quarter,
               dayofweek(date_day) IN (0, 6) AS is_weekend
        FROM spine
        """,
    ),
    "priced": (
        ("stg_order_items", "dim_products"),
        """
        SELECT i.*, p.cost,
               CASE WHEN status = 'Returned' THEN 0 ELSE sale_price END AS net_revenue
        FROM stg_order_items i LEFT JOIN dim_products p ON p.product_id = i.product_id
        """,
    ),
    "fct_order_items": (
        ("priced",),
        """
        SELECT *, CAST(ordered_at AS DATE) AS ordered_date,
               CAST(delivered_at AS DATE) AS delivered_date,
               net_revenue - cost AS gross_margin,
               (net_revenue - cost) / NULLIF(net_revenue, 0) AS gross_margin_rate,
               COALESCE(status = 'Returned', FALSE) AS is_returned,
               delivered_at IS NOT NULL AS is_delivered,
               date_diff('day', ordered_at, delivered_at) AS days_to_delivery
        FROM priced
        """,
    ),
    "order_totals": (
        ("fct_order_items",),
        f"""
        SELECT order_id, COUNT(*) AS items_count,
               COUNT(*) FILTER (WHERE is_returned) AS returned_items_count,
               {money('sale_price')} AS total_revenue_gross,
               {money('net_revenue')} AS total_revenue_net,
               {money('cost')} AS total_cost,
               {money('gross_margin')} AS total_gross_margin,
               {money('sale_price')} / NULLIF(COUNT(sale_price), 0) AS average_item_price
        FROM fct_order_items GROUP BY order_id
        """,
    ),
    "order_flags": (
        ("order_totals",),
        """
        SELECT *, items_count = returned_items_count AS is_fully_returned,
               returned_items_count BETWEEN 1 AND items_count - 1 AS is_partially_returned,
               total_gross_margin / NULLIF(total_revenue_net, 0) AS gross_margin_rate
        FROM order_totals
        """,
    ),
    "fct_orders": (
        ("order_flags", "stg_orders"),
        """
        SELECT f.*, o.* EXCLUDE (order_id, num_of_item),
               CAST(o.ordered_at AS DATE) AS ordered_date,
               CAST(o.delivered_at AS DATE) AS delivered_date
        FROM order_flags f JOIN stg_orders o ON o.order_id = f.order_id
        """,
    ),
}


def sql(select: str, *reads: str) -> str:
    """``select`` behind the table expressions it reads, in order of need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in TABLES[name][0]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in reads:
        add(name)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n][1]})" for n in ordered) + "\n" + select


def rows_of(model: str, only: list[str] | None = None) -> str:
    columns = only or COLUMNS[model]
    shown = ", ".join(f"{text(c)} AS {c}" if c in TIMES else c for c in columns)
    return sql(f"SELECT {shown} FROM {model}", model)


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def row(table: str, model: str, column: str, test: str, failures: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", '{test}' AS test, "
        f"{failures} AS failures FROM {table}"
    )


def not_null_rows(tests) -> list[str]:
    return [
        row(m, m, c, "not_null", f"COUNT(*) - COUNT({c})") for m, cs in tests.items() for c in cs
    ]


def unique_rows(tests) -> list[str]:
    return [
        row(
            f"(SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)",
            m,
            c,
            "unique",
            "COUNT(*)",
        )
        for m, c in tests
    ]


def relationship_rows(tests) -> list[str]:
    return [
        row(
            f"{child} WHERE {column} IS NOT NULL AND {column} NOT IN "
            f"(SELECT {field} FROM {parent} WHERE {field} IS NOT NULL)",
            child,
            column,
            f"relationships:{parent}.{field}",
            "COUNT(*)",
        )
        for child, column, parent, field in tests
    ]


def landing_columns(table: str) -> str:
    """A landing table's own columns, timestamps as text."""
    columns = {
        "users": "id first_name last_name email age gender state street_address postal_code city "
        "country latitude longitude traffic_source created_at",
        "products": "id cost category name brand retail_price department sku distribution_center_id",
        "orders": "order_id user_id status gender created_at returned_at shipped_at delivered_at "
        "num_of_item",
        "order_items": "id order_id user_id product_id inventory_item_id status created_at "
        "shipped_at delivered_at returned_at sale_price",
    }[table].split()
    return ", ".join(f"{text(c)} AS {c}" if c in TIMES else c for c in columns)
