"""Calendar attributes of a date."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


#: The column that stored tables are laid out by.
MONTH = "partition_month"


def day_of_week(day: Column) -> Column:
    """0 is Sunday, 6 is Saturday; Spark's own count starts at 1."""
    return (F.dayofweek(day) - 1).cast("bigint")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def year_quarter(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def is_weekend(day: Column) -> Column:
    return day_of_week(day).isin(0, 6)


def default_end(years: int = 2) -> Column:
    """Today plus some years; 29 February becomes 28 February."""
    return F.add_months(F.current_date(), 12 * years)


def moment_text(value: date | datetime) -> str:
    """The moment in UTC as text that casts to a timestamp."""
    if not isinstance(value, datetime):
        return value.isoformat()
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc)
    return value.strftime("%Y-%m-%d %H:%M:%S.%f")


def moment(value: date | datetime) -> Column:
    """A timestamp literal read as UTC, whatever zone the driver machine is in."""
    literal = moment_text(value) if isinstance(value, datetime) else value
    return F.lit(literal).cast("timestamp")
