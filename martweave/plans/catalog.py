"""Stored models as tables of the session's catalog, one database per environment and layer.

Tables stay where the build put them; the catalog gets their place, columns and months,
so that ``spark.sql`` finds ``<schema>.<model>`` and prunes months. Beside each lies a
view of the columns that anyone may see, which is evaluated when it is read.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from martweave.functions.calendar import MONTH
from martweave.operators.contracts import CONTRACTS
from martweave.plans.build import MODELS, mart
from martweave.plans.namespaces import schema_name

OPEN = "public"


def _named(*parts: str) -> str:
    return ".".join(f"`{p}`" for p in parts)


def catalogue(spark: SparkSession, root: str, environment: str = "dev", base: str = "analytics") -> list[str]:
    """Enter all stored models that are there; returns their names. May be repeated."""
    entered = []
    for name, model in MODELS.items():
        if not model.stored:
            continue
        schema = schema_name(environment, base, model.layer)
        table = mart(spark, f"{root.rstrip('/')}/{schema}", name)
        if table.is_new():
            continue
        place = f"{table.root}/rows"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_named(schema)}")
        spark.sql(f"DROP VIEW IF EXISTS {_named(schema, f'{name}_{OPEN}')}")
        spark.sql(f"DROP TABLE IF EXISTS {_named(schema, name)}")  # the table is external: its rows stay
        columns = f"{table.ddl}, `{MONTH}` string"
        escaped = place.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {_named(schema, name)} ({columns}) USING parquet "
            f"PARTITIONED BY (`{MONTH}`) LOCATION '{escaped}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {_named(schema, name)}")
        contract = CONTRACTS[name]
        seen = ", ".join(f"`{c}`" for c in contract.names() if contract.data_class(c) == OPEN)
        spark.sql(f"CREATE VIEW {_named(schema, f'{name}_{OPEN}')} AS SELECT {seen} FROM {_named(schema, name)}")
        entered.append(f"{schema}.{name}")
    return entered
