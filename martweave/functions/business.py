"""The business definitions, each written once.

Only a returned item is zeroed. Cancelled and processing items count as revenue,
and so does an item without a status.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martweave.functions.money import rate

# Fixed value: the item status that takes revenue back.
RETURNED = "Returned"


def is_returned(status: Column) -> Column:
    """False, not NULL, when the status is missing."""
    return status.eqNullSafe(RETURNED)


def net_revenue(status: Column, sale_price: Column) -> Column:
    return F.when(is_returned(status), F.lit(0.0)).otherwise(sale_price)


def gross_margin(revenue: Column, cost: Column) -> Column:
    """A returned item loses its cost; an unknown cost makes the margin unknown."""
    return revenue - cost


def gross_margin_rate(margin: Column, revenue: Column) -> Column:
    return rate(margin, revenue)


def is_delivered(delivered_at: Column) -> Column:
    return delivered_at.isNotNull()


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed, not blocks of 24 hours: 23:00 to 01:00 is one day."""
    return F.datediff(end, start).cast("bigint")


def is_fully_returned(items: Column, returned: Column) -> Column:
    return items == returned


def is_partially_returned(items: Column, returned: Column) -> Column:
    return (returned > 0) & (returned < items)
