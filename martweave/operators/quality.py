"""Data tests as DataFrames that count violations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, IntegerType, LongType, ShortType

# The declared data tests.
NOT_NULL = {
    "stg_users": ("user_id", "registered_at"),
    "stg_products": ("product_id",),
    "stg_orders": ("order_id", "ordered_at"),
    "stg_order_items": ("order_item_id", "ordered_at"),
    "dim_users": ("user_id", "registered_at"),
    "dim_products": ("product_id",),
    "dim_dates": ("date_day",),
    "fct_order_items": ("order_item_id", "order_id", "user_id", "product_id", "ordered_date"),
    "fct_orders": ("order_id", "user_id", "ordered_date"),
}
UNIQUE = {
    "stg_users": "user_id",
    "stg_products": "product_id",
    "stg_orders": "order_id",
    "stg_order_items": "order_item_id",
    "dim_users": "user_id",
    "dim_products": "product_id",
    "dim_dates": "date_day",
    "fct_order_items": "order_item_id",
    "fct_orders": "order_id",
}


@dataclass(frozen=True)
class Relationship:
    child: str
    column: str
    parent: str
    field: str


RELATIONSHIPS = (
    Relationship("fct_order_items", "user_id", "dim_users", "user_id"),
    Relationship("fct_orders", "user_id", "dim_users", "user_id"),
)

# Tests the models name but do not run yet; they only warn here.
DEFERRED_NOT_NULL = {"stg_users": ("email",)}
DEFERRED_UNIQUE = (("stg_products", "sku"), ("dim_products", "sku"), ("stg_users", "email"))
DEFERRED_RELATIONSHIPS = (
    Relationship("fct_order_items", "product_id", "dim_products", "product_id"),
    Relationship("stg_orders", "user_id", "stg_users", "user_id"),
)
ACCEPTED_VALUES = {
    ("stg_orders", "status"): ("Processing", "Shipped", "Complete", "Cancelled", "Returned"),
    ("stg_users", "gender"): ("F", "M"),
}


def _result(df: DataFrame, test: str, model: str, column: str) -> DataFrame:
    return df.select(
        F.lit(model).alias("model"),
        F.lit(column).alias("column"),
        F.lit(test).alias("test"),
        "failures",
    )


def column_tests(
    df: DataFrame,
    model: str,
    not_null: tuple[str, ...] = (),
    accepted: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """A row per column and test with its violations; one pass for all of them."""
    accepted = accepted or {}
    tests = [("not_null", c, F.col(c).isNull()) for c in not_null]
    # A NULL is no value and so no wrong one: ``isin`` of it is NULL and not counted.
    tests += [("accepted_values", c, ~F.col(c).isin(*values)) for c, values in accepted.items()]
    counts = df.agg(*(F.count_if(broken).alias(f"_{k}") for k, (_, _, broken) in enumerate(tests)))
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(column).alias("column"),
            F.lit(test).alias("test"),
            F.col(f"_{k}").alias("failures"),
        )
        for k, (test, column, _) in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*rows)))


def not_null(df: DataFrame, model: str, columns: tuple[str, ...]) -> DataFrame:
    return column_tests(df, model, columns)


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Each non-null value that occurs more than once, and how often.

    Copies are counted in each task before the shuffle, so a value with a great
    many of them is one row per task.
    """
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    found = repeated_keys(df, column).agg(F.count(F.lit(1)).alias("failures"))
    return _result(found, "unique", model, column)


_WHOLE = (ByteType, ShortType, IntegerType, LongType, DateType)


def _plain_key(df: DataFrame, column: str) -> Column:
    """Integers and dates as a number."""
    kind = df.schema[column].dataType
    return (F.unix_date(column) if isinstance(kind, DateType) else F.col(column)).cast("bigint")


def uniques(models: dict[str, DataFrame], tests: Sequence[tuple[str, str]]) -> DataFrame:
    """As :func:`unique` for several (model, column) at once: one shuffle for all of them.

    Keys are numbers if all are integers or dates, else text.
    """
    whole = all(isinstance(models[m].schema[c].dataType, _WHOLE) for m, c in tests)

    def keys(k: int, model: str, column: str) -> DataFrame:
        df = models[model].filter(F.col(column).isNotNull())
        key = _plain_key(df, column) if whole else F.col(column).cast("string")
        return df.select(F.lit(k).alias("_test"), key.alias("_key"))

    stacked = reduce(DataFrame.unionByName, (keys(k, m, c) for k, (m, c) in enumerate(tests)))
    repeated = stacked.groupBy("_test", "_key").agg(F.count(F.lit(1)).alias("_copies")).filter("_copies > 1")
    sums = repeated.agg(*(F.count_if(F.col("_test") == k).alias(f"_{k}") for k in range(len(tests))))
    rows = [
        F.struct(
            F.lit(model).alias("model"), F.lit(column).alias("column"), F.lit("unique").alias("test"), F.col(f"_{k}").alias("failures")
        )
        for k, (model, column) in enumerate(tests)
    ]
    return sums.select(F.inline(F.array(*rows)))


def repeated_in_load(
    table: DataFrame, column: str, load_id: str, load_column: str = "_load_id"
) -> DataFrame:
    """Key values by which a load breaks the uniqueness of a table that was unique before.

    The load's keys are held against each other and against those of all other loads.
    Rows of the table that cannot be among them are ruled out by a Bloom filter over the
    load's keys, which Spark puts into the scan of a large table, or by the broadcast of
    a small load; only what is left is compared exactly. Nothing groups the whole table.
    """
    known = table.filter(F.col(column).isNotNull())
    own = known.filter(F.col(load_column) == load_id).select(column)
    others = known.filter(~F.col(load_column).eqNullSafe(load_id)).select(column)
    inside = repeated_keys(own, column).select(column)
    return inside.union(others.join(own, column, "left_semi")).distinct()


def unique_in_load(table: DataFrame, model: str, column: str, load_id: str) -> DataFrame:
    found = repeated_in_load(table, column, load_id).agg(F.count(F.lit(1)).alias("failures"))
    return _result(found, "unique_in_load", model, column)


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str, *also: str) -> DataFrame:
    """Foreign keys without a parent row, with the number of child rows of each.

    NULL is not an orphan. Child rows are counted per key, and per further
    column named, before the join: what meets the parent is one row per key.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column, *also)
    counted = keys.agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(parent.select(F.col(field).alias(column)), column, "left_anti")


def relationship(models: dict[str, DataFrame], r: Relationship) -> DataFrame:
    found = orphans(models[r.child], r.column, models[r.parent], r.field)
    total = found.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("failures"))
    return _result(total, f"relationships:{r.parent}.{r.field}", r.child, r.column)


def relationships(models: dict[str, DataFrame], tests: Sequence[Relationship]) -> DataFrame:
    """As :func:`relationship` for several tests at once.

    A child is read once for all its columns and its keys are counted on their own, so
    that a task makes the rows of one child only: Spark shares a stage's tasks out among
    what is stacked in it, and a child of few bytes but many rows would get very few.
    What is left of all children, a row a key, meets the keys of all parents in one join.
    Keys are compared as integers if all are, else as text; parents go by number.
    """
    named = [(r.child, r.column) for r in tests] + [(r.parent, r.field) for r in tests]
    whole = all(isinstance(models[m].schema[c].dataType, _WHOLE[:-1]) for m, c in named)

    def key(column: str) -> Column:
        return F.col(column).cast("bigint" if whole else "string").alias("_key")

    fields = list(dict.fromkeys((r.parent, r.field) for r in tests))

    def counted(child: str) -> DataFrame:
        own = [(k, fields.index((r.parent, r.field)), r) for k, r in enumerate(tests) if r.child == child]
        rows = [F.struct(F.lit(k).alias("_test"), F.lit(p).alias("_parent"), key(r.column)) for k, p, r in own]
        found = models[child].select(F.inline(F.array(*rows))).filter(F.col("_key").isNotNull())
        mine = found.groupBy("_parent", "_key").agg(*(F.count_if(F.col("_test") == k).alias(f"_{k}") for k, _, _ in own))
        return mine.withColumns({f"_{k}": F.lit(0).cast("bigint") for k in range(len(tests)) if f"_{k}" not in mine.columns})

    children = reduce(DataFrame.unionByName, map(counted, dict.fromkeys(r.child for r in tests)))
    keys = reduce(
        DataFrame.unionByName,
        (models[parent].select(F.lit(p).alias("_parent"), key(field)) for p, (parent, field) in enumerate(fields)),
    )
    missing = children.join(keys, ["_parent", "_key"], "left_anti")
    sums = missing.agg(*(F.coalesce(F.sum(f"_{k}"), F.lit(0)).cast("bigint").alias(f"_{k}") for k in range(len(tests))))
    rows = [
        F.struct(
            F.lit(r.child).alias("model"),
            F.lit(r.column).alias("column"),
            F.lit(f"relationships:{r.parent}.{r.field}").alias("test"),
            F.col(f"_{k}").alias("failures"),
        )
        for k, r in enumerate(tests)
    ]
    return sums.select(F.inline(F.array(*rows)))


def orphans_by_day(
    child: DataFrame, column: str, parent: DataFrame, field: str, day: str
) -> DataFrame:
    """On which days the orphans lie, to tell a cut-off effect from bad data."""
    found = orphans(child, column, parent, field, day)
    return found.groupBy(day).agg(
        F.count(F.lit(1)).alias("orphan_keys"), F.sum("rows").alias("orphan_rows")
    )


def value_counts(df: DataFrame, model: str, column: str, accepted: tuple[str, ...]) -> DataFrame:
    """Each non-null value, its rows, and whether it is an accepted one."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(
        F.lit(model).alias("model"),
        F.lit(column).alias("column"),
        F.col(column).alias("value"),
        "rows",
        F.col(column).isin(*accepted).alias("accepted"),
    )


def accepted_values(df: DataFrame, model: str, column: str, accepted: tuple[str, ...]) -> DataFrame:
    return column_tests(df, model, accepted={column: accepted})


def model_tests(name: str, models: dict[str, DataFrame], deferred: bool = False) -> DataFrame | None:
    """Every test declared for one model: model, column, test, failures, severity.

    ``models`` holds the model and whatever its keys refer to. All tests of single
    columns are one pass; each tested key is one grouped pass over that column.
    """
    df = models[name]

    def of(kind: str, not_null_of: dict, unique_of, relationships, accepted) -> list[DataFrame]:
        found = []
        columns, values = not_null_of.get(name, ()), {c: v for (m, c), v in accepted.items() if m == name}
        if columns or values:
            found.append(column_tests(df, name, columns, values))
        found += [unique(df, name, c) for m, c in unique_of if m == name]
        found += [relationship(models, r) for r in relationships if r.child == name]
        return [f.withColumn("severity", F.lit(kind)) for f in found]

    results = of("error", NOT_NULL, UNIQUE.items(), RELATIONSHIPS, {})
    if deferred:
        results += of("warn", DEFERRED_NOT_NULL, DEFERRED_UNIQUE, DEFERRED_RELATIONSHIPS, ACCEPTED_VALUES)
    return reduce(DataFrame.unionByName, results) if results else None


def parents(name: str, deferred: bool = False) -> set[str]:
    """The models that the tests of a model compare it with."""
    tests = (*RELATIONSHIPS, *DEFERRED_RELATIONSHIPS) if deferred else RELATIONSHIPS
    return {r.parent for r in tests if r.child == name}
