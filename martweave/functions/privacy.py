"""Salted pseudonymisation of personal columns."""

from __future__ import annotations

import os

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SALT_VARIABLE = "PSEUDONYMISATION_SALT"


class SaltMissing(RuntimeError):
    """No salt was configured, so nothing personal may be read."""


def salt_from_env(variable: str = SALT_VARIABLE) -> str:
    value = os.environ.get(variable)
    if not value:
        raise SaltMissing(f"set {variable} before building models with personal columns")
    return value


def salt_column(spark: SparkSession, salt: str) -> Column:
    """The salt as a scalar subquery.

    As a literal the salt would be readable in every plan, in the UI and in the
    event log. A subquery is planned by reference and its value stays out of them.
    """
    if not salt:
        raise SaltMissing("the pseudonymisation salt is empty")
    return spark.createDataFrame([(salt,)], "salt string").scalar()


def pseudonymise(column: Column | str, salt: Column) -> Column:
    """64 hex characters, equal for equal input; NULL stays NULL.

    ``concat`` passes NULL on. ``concat_ws`` would skip it and hash the bare salt.
    """
    value = F.col(column) if isinstance(column, str) else column
    return F.sha2(F.concat(value, salt), 256)
