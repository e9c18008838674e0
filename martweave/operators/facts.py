"""The two facts: one row per order item, one row per order.

The item fact defines every measure; the order fact only adds them up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martweave.functions import business
from martweave.functions.audit import Run
from martweave.functions.money import UNITS, exact_avg, exact_sum, rate
from martweave.operators.contracts import CONTRACTS


def _contract_columns(df: DataFrame, model: str) -> DataFrame:
    return df.select(*(name for name, _ in CONTRACTS[model].business))


def with_dates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "ordered_date": F.to_date("ordered_at"),
            "delivered_date": F.to_date("delivered_at"),
        }
    )


def with_cost(items: DataFrame, products: DataFrame) -> DataFrame:
    """Look up the cost; an item whose product is unknown stays, without a cost.

    No broadcast is forced. A catalogue below the session's broadcast limit is
    sent to the tasks; a larger one is joined by shuffle, where a best-seller's
    partition is split, which a left join allows on its left side.
    """
    return items.join(products.select("product_id", "cost"), "product_id", "left")


def with_net_revenue(items: DataFrame) -> DataFrame:
    return items.withColumn(
        "net_revenue", business.net_revenue(F.col("status"), F.col("sale_price"))
    )


def with_margin(items: DataFrame) -> DataFrame:
    margin = business.gross_margin(F.col("net_revenue"), F.col("cost"))
    return items.withColumns(
        {
            "gross_margin": margin,
            "gross_margin_rate": business.gross_margin_rate(margin, F.col("net_revenue")),
        }
    )


def with_item_flags(items: DataFrame) -> DataFrame:
    return items.withColumns(
        {
            "is_returned": business.is_returned(F.col("status")),
            "is_delivered": business.is_delivered(F.col("delivered_at")),
        }
    )


def with_days_to_delivery(items: DataFrame) -> DataFrame:
    return items.withColumn(
        "days_to_delivery", business.days_between(F.col("ordered_at"), F.col("delivered_at"))
    )


def item_measures(stg_order_items: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Staged items with every measure of the item fact added."""
    return (
        stg_order_items.transform(with_cost, dim_products)
        .transform(with_dates)
        .transform(with_net_revenue)
        .transform(with_margin)
        .transform(with_item_flags)
        .transform(with_days_to_delivery)
    )


def fct_order_items(stg_order_items: DataFrame, dim_products: DataFrame, run: Run) -> DataFrame:
    items = item_measures(stg_order_items, dim_products)
    return run.stamp(_contract_columns(items, "fct_order_items"))


def order_totals(items: DataFrame, units: float | None = UNITS) -> DataFrame:
    """Item measures added up per order.

    Each task adds up its own rows first, so an order of any size reaches the
    shuffle as one row per task. Missing costs and margins are skipped, so the
    margin of an order with an unknown cost is not its revenue less its cost.
    """
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items_count"),
        F.count_if("is_returned").alias("returned_items_count"),
        exact_sum("sale_price", units).alias("total_revenue_gross"),
        exact_sum("net_revenue", units).alias("total_revenue_net"),
        exact_sum("cost", units).alias("total_cost"),
        exact_sum("gross_margin", units).alias("total_gross_margin"),
        exact_avg("sale_price", units).alias("average_item_price"),
    )


def with_return_flags(totals: DataFrame) -> DataFrame:
    counts = F.col("items_count"), F.col("returned_items_count")
    return totals.withColumns(
        {
            "is_fully_returned": business.is_fully_returned(*counts),
            "is_partially_returned": business.is_partially_returned(*counts),
        }
    )


def with_order_margin_rate(totals: DataFrame) -> DataFrame:
    return totals.withColumn(
        "gross_margin_rate", rate(F.col("total_gross_margin"), F.col("total_revenue_net"))
    )


def with_order_attributes(totals: DataFrame, orders: DataFrame) -> DataFrame:
    """Add the order's own columns; totals without an order are left out.

    The totals arrive hashed by ``order_id`` already, so only the orders move.
    """
    attributes = orders.select(
        "order_id",
        "user_id",
        "status",
        "gender",
        "ordered_at",
        "shipped_at",
        "delivered_at",
        "returned_at",
    )
    return totals.join(attributes, "order_id", "inner")


def fct_orders(
    fct_order_items: DataFrame, stg_orders: DataFrame, run: Run, units: float | None = UNITS
) -> DataFrame:
    orders = (
        order_totals(fct_order_items, units)
        .transform(with_return_flags)
        .transform(with_order_margin_rate)
        .transform(with_order_attributes, stg_orders)
        .transform(with_dates)
    )
    return run.stamp(_contract_columns(orders, "fct_orders"))
