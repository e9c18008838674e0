"""Staging: one landed row in, one typed and renamed row out.

The projection follows the contract: declared numbers are cast, declared personal
columns are hashed, everything else passes through. Under ANSI a value that is
not a number stops the run, and so does a fraction in a column of whole numbers.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, FractionalType

from martweave.functions.audit import Run
from martweave.functions.calendar import moment
from martweave.functions.privacy import pseudonymise
from martweave.operators.contracts import CONTRACTS

# Fixed value: first day of the analysis.
HORIZON = date(2023, 1, 1)

# Staged name of each landed column that is renamed.
RENAMED = {
    "stg_users": {"user_id": "id", "registered_at": "created_at"},
    "stg_products": {"product_id": "id"},
    "stg_orders": {"ordered_at": "created_at"},
    "stg_order_items": {"order_item_id": "id", "ordered_at": "created_at"},
}

_NUMBERS = {"bigint", "double"}


def _number(value: Column, stored: DataType, kind: str, name: str) -> Column:
    """The value as a number; a fraction where a whole number is declared stops the run."""
    number = value.cast(kind)
    if kind != "bigint" or not isinstance(stored, FractionalType):
        return number
    text = F.concat(F.lit(f"{name} is declared {kind} and holds "), value.cast("string"))
    return F.when(value.isNull() | (value == F.floor(value)), number).otherwise(F.raise_error(text))


def _stage(
    raw: DataFrame,
    model: str,
    run: Run,
    salt: Column | None = None,
    only: list[str] | None = None,
) -> DataFrame:
    contract = CONTRACTS[model]
    selected = []
    for name, kind in contract.business:
        if only is not None and name not in only:
            continue
        value = F.col(RENAMED[model].get(name, name))
        if name in contract.personal:
            value = pseudonymise(value, salt)
        elif kind in _NUMBERS:
            value = _number(value, raw.schema[RENAMED[model].get(name, name)].dataType, kind, name)
        selected.append(value.alias(name))
    return run.stamp(raw.select(*selected))


def stg_users(raw: DataFrame, run: Run, salt: Column) -> DataFrame:
    return _stage(raw, "stg_users", run, salt)


def stg_products(raw: DataFrame, run: Run) -> DataFrame:
    return _stage(raw, "stg_products", run)


def stg_orders(raw: DataFrame, run: Run) -> DataFrame:
    """No horizon: an item inside it may belong to an order placed before it."""
    return _stage(raw, "stg_orders", run)


def within_horizon(raw: DataFrame, horizon: date | datetime = HORIZON) -> DataFrame:
    """Rows created on or after the horizon; the bound reaches the parquet scan."""
    return raw.filter(F.col("created_at") >= moment(horizon).cast(raw.schema["created_at"].dataType))


def stg_order_items(
    raw: DataFrame,
    run: Run,
    horizon: date | datetime = HORIZON,
    only: list[str] | None = None,
) -> DataFrame:
    """The event stream, cut at the horizon.

    ``only`` names the staged columns wanted, for a source that must join to
    supply the others.
    """
    return _stage(within_horizon(raw, horizon), "stg_order_items", run, only=only)
