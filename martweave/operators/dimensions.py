"""Conformed dimensions: users, products, dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.functions import calendar
from martweave.functions.audit import Run
from martweave.operators.contracts import CONTRACTS
from martweave.operators.staging import HORIZON


def _pass_through(staged: DataFrame, model: str, run: Run) -> DataFrame:
    return run.stamp(staged.select(*(name for name, _ in CONTRACTS[model].business)))


def dim_users(stg_users: DataFrame, run: Run) -> DataFrame:
    return _pass_through(stg_users, "dim_users", run)


def dim_products(stg_products: DataFrame, run: Run) -> DataFrame:
    return _pass_through(stg_products, "dim_products", run)


def days(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """``date_day`` for each day from ``start`` up to but not including ``end``.

    ``bounds`` is a one-row DataFrame the two columns are read from. No row
    comes out of an empty span.
    """
    span = F.when(start < end, F.sequence(start, F.date_sub(end, 1)))
    return bounds.select(F.explode(span).alias("date_day"))


def date_spine(
    spark: SparkSession, start: date | Column = HORIZON, end: date | Column | None = None
) -> DataFrame:
    """Calendar days; ``end`` is exclusive and defaults to two years from today."""
    first = start if isinstance(start, Column) else F.lit(start)
    last = calendar.default_end() if end is None else end if isinstance(end, Column) else F.lit(end)
    return days(spark.range(1), first, last)


def spine_over(df: DataFrame, *day_columns: str) -> DataFrame:
    """The spine from the first to the last day seen in any of the columns.

    Only the two bounds are shuffled, one row per task.
    """
    bounds = df.agg(
        F.min(F.least(*map(F.col, day_columns)) if len(day_columns) > 1 else day_columns[0]).alias("first"),
        F.max(F.greatest(*map(F.col, day_columns)) if len(day_columns) > 1 else day_columns[0]).alias("last"),
    )
    return days(bounds, F.col("first"), F.date_add("last", 1))


def dim_dates(spine: DataFrame) -> DataFrame:
    """Calendar attributes per day. No audit columns: it has no source to trace."""
    day = F.col("date_day")
    return spine.select(
        day,
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        F.dayofmonth(day).cast("bigint").alias("day"),
        calendar.day_of_week(day).alias("day_of_week"),
        F.dayofyear(day).cast("bigint").alias("day_of_year"),
        calendar.year_month(day).alias("year_month"),
        calendar.year_quarter(day).alias("year_quarter"),
        calendar.is_weekend(day).alias("is_weekend"),
    )
