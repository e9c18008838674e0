from __future__ import annotations

from datetime import date, datetime

import pytest
from support import values
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F

from martweave.functions.audit import Run
from martweave.functions.privacy import salt_column
from martweave.operators import dimensions, facts, staging
from martweave.operators.contracts import CONTRACTS, differences
from martweave.sources.landing import LANDINGS

RUN = Run("run", datetime(2024, 6, 1))


def ts(text):
    return None if text is None else datetime.fromisoformat(text)


def raw_items(spark, rows):
    """(id, order, product, status, price, created, delivered)"""
    full = [
        (i, o, 7, p, 9, status, ts(created), None, ts(delivered), None, price)
        for i, o, p, status, price, created, delivered in rows
    ]
    return spark.createDataFrame(full, LANDINGS["order_items"].ddl)


def raw_orders(spark, rows):
    """(order, created)"""
    full = [(o, 7, "Complete", "F", ts(created), None, None, None, 1) for o, created in rows]
    return spark.createDataFrame(full, LANDINGS["orders"].ddl)


def products(spark, rows=((1, 40.0),)):
    full = [(i, cost, "c", "n", "b", 100.0, "d", "s", 1) for i, cost in rows]
    raw = spark.createDataFrame(full, LANDINGS["products"].ddl)
    return dimensions.dim_products(staging.stg_products(raw, RUN), RUN)


DAY = "2024-03-01 10:00:00"


def item_fact(spark, rows, catalogue=None):
    staged = staging.stg_order_items(raw_items(spark, rows), RUN)
    return facts.fct_order_items(staged, catalogue or products(spark), RUN)


def order_fact(spark, rows, orders):
    return facts.fct_orders(item_fact(spark, rows), staging.stg_orders(raw_orders(spark, orders), RUN), RUN)


@pytest.mark.parametrize(
    "product, status, price, expected",
    [
        (1, "Returned", 100.0, (0.0, -40.0, None, True)),
        (1, None, 100.0, (100.0, 60.0, 0.6, False)),
        (1, "Cancelled", 100.0, (100.0, 60.0, 0.6, False)),
        (2, "Complete", 100.0, (100.0, None, None, False)),
        (1, "Complete", 0.0, (0.0, -40.0, None, False)),
        (None, "Complete", 100.0, (100.0, None, None, False)),
    ],
)
def test_item_measures(spark, product, status, price, expected):
    fact = item_fact(spark, [(1, 1, product, status, price, DAY, None)])
    assert values(fact, "net_revenue", "gross_margin", "gross_margin_rate", "is_returned") == [expected]


def test_delivery_columns(spark):
    fact = item_fact(
        spark,
        [
            (1, 1, 1, "Complete", 1.0, "2024-03-01 23:00:00", "2024-03-02 01:00:00"),
            (2, 1, 1, "Complete", 1.0, "2024-03-01 23:00:00", None),
        ],
    )
    assert values(fact, "order_item_id", "is_delivered", "days_to_delivery", "ordered_date", "delivered_date") == [
        (1, True, 1, date(2024, 3, 1), date(2024, 3, 2)),
        (2, False, None, date(2024, 3, 1), None),
    ]


def test_order_with_an_unknown_cost(spark):
    fact = order_fact(
        spark,
        [(1, 1, 1, "Complete", 100.0, DAY, None), (2, 1, 2, "Complete", 50.0, DAY, None)],
        [(1, DAY)],
    )
    assert values(
        fact, "total_cost", "total_gross_margin", "total_revenue_net", "gross_margin_rate", "average_item_price"
    ) == [(40.0, 60.0, 150.0, 0.4, 75.0)]


def test_order_return_flags(spark):
    rows = [
        (i, i // 10, 1, "Returned" if back else "Complete", 10.0, DAY, None)
        for i, back in ((10, 1), (11, 1), (20, 1), (21, 0), (30, 0), (31, 0))
    ]
    fact = order_fact(spark, rows, [(1, DAY), (2, DAY), (3, DAY)])
    assert values(
        fact, "order_id", "returned_items_count", "is_fully_returned", "is_partially_returned", "gross_margin_rate"
    ) == [
        (1, 2, True, False, None),
        (2, 1, False, True, -7.0),
        (3, 0, False, False, -3.0),
    ]


def test_inner_join_drops_both_ways(spark):
    rows = [(1, 1, 1, "Complete", 1.0, DAY, None), (2, 2, 1, "Complete", 1.0, DAY, None)]
    assert values(order_fact(spark, rows, [(1, DAY), (3, DAY)]), "order_id") == [(1,)]


def test_horizon_cuts_items_not_orders(spark):
    rows = [
        (1, 1, 1, "Complete", 1.0, "2022-12-31 23:59:59", None),
        (2, 1, 1, "Complete", 2.0, "2023-01-01 00:00:00", None),
    ]
    orders = [(1, "2022-12-31 08:00:00")]
    fact = order_fact(spark, rows, orders)
    assert values(fact, "order_id", "items_count", "total_revenue_gross", "ordered_date") == [
        (1, 1, 2.0, date(2022, 12, 31))
    ]
    spine = dimensions.date_spine(spark, end=date(2024, 1, 1))
    assert fact.join(spine, fact.ordered_date == spine.date_day, "left_anti").count() == 1


def test_user_staging(spark):
    row = (1, "a", "b", None, 30, "F", "s", "street", "p", "c", "x", 1.0, 2.0, "Search", ts(DAY))
    raw = spark.createDataFrame([row], LANDINGS["users"].ddl)
    staged = staging.stg_users(raw, RUN, salt_column(spark, "salt"))
    dim = dimensions.dim_users(staged, Run("later"))
    got = dim.first()
    assert (got.user_id, got.email, got.age, got.registered_at) == (1, None, 30, ts(DAY))
    assert len(got.first_name) == len(got.last_name) == len(got.street_address) == 64
    assert got._run_id == "later"


def test_malformed_number_stops_the_run(spark):
    raw = spark.createDataFrame([("1x",)], "id string")
    for column in ("cost", "category", "name", "brand", "retail_price", "department", "sku"):
        raw = raw.withColumn(column, F.lit("1"))
    raw = raw.withColumn("distribution_center_id", F.lit("1"))
    with pytest.raises((NumberFormatException, ArithmeticException)):
        staging.stg_products(raw, RUN).collect()


def test_every_model_meets_its_contract(spark, folder):
    import __spark_entry__ as entry

    context = entry.Context(spark, folder)
    models = context.models(*CONTRACTS)
    assert {m: differences(df, m) for m, df in models.items()} == {m: [] for m in CONTRACTS}


def test_spine_end_is_exclusive_and_covers_leap_day(spark):
    spine = dimensions.date_spine(spark, date(2024, 2, 28), date(2024, 3, 1))
    assert values(spine, "date_day") == [(date(2024, 2, 28),), (date(2024, 2, 29),)]
    assert dimensions.date_spine(spark, date(2024, 1, 2), date(2024, 1, 2)).count() == 0


def test_default_spine_reaches_two_years_ahead(spark):
    spine = dimensions.date_spine(spark)
    first, last = spine.selectExpr("min(date_day)", "max(date_day)").first()
    expected = spark.sql("select date_sub(add_months(current_date(), 24), 1)").first()[0]
    assert (first, last) == (date(2023, 1, 1), expected)


def test_spine_over_columns_with_nulls(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 3), None), (date(2024, 1, 1), date(2024, 1, 5)), (None, None)], "a date, b date"
    )
    assert dimensions.spine_over(df, "a", "b").count() == 5
    assert dimensions.spine_over(df, "a").count() == 3
    assert dimensions.spine_over(df.limit(0), "a").count() == 0


def test_calendar_row(spark):
    rows = dimensions.dim_dates(dimensions.date_spine(spark, date(2024, 1, 7), date(2024, 1, 8))).collect()
    assert [tuple(r) for r in rows] == [
        (date(2024, 1, 7), 2024, 1, 1, 7, 0, 7, "2024-01", "2024-Q1", True)
    ]


def test_a_fraction_in_a_whole_number_stops_the_run(spark):
    def staged(value):
        raw = spark.createDataFrame([(1, value)], "id bigint, order_id double")
        rest = [c for c in LANDINGS["order_items"].ddl.split(", ") if c.split()[0] not in raw.columns]
        for c in rest:
            name, kind = c.split()
            raw = raw.withColumn(name, F.lit("2030-01-01").cast(kind) if name == "created_at" else F.lit(None).cast(kind))
        return staging.stg_order_items(raw, RUN).first().order_id

    assert staged(2.0) == 2 and staged(None) is None
    with pytest.raises(Exception, match="declared bigint and holds 2.7"):
        staged(2.7)
