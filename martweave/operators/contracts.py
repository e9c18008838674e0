"""Declared output columns of the nine models, and the check that enforces them.

``DataFrame.to(schema)`` is no such check: it casts what differs and fills what is
missing. Here names and types are compared and any difference stops the write.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Classes of data, the least guarded first.
DATA_CLASSES = ("public", "internal", "pii", "sensitive_pii")

AUDIT = (("_loaded_at", "timestamp"), ("_run_id", "string"))

# Model columns and types.
_USERS = """
    user_id bigint, first_name string, last_name string, email string, street_address string,
    age bigint, gender string, state string, postal_code string, city string, country string,
    latitude double, longitude double, traffic_source string, registered_at timestamp
"""
_PRODUCTS = """
    product_id bigint, cost double, retail_price double, category string, name string,
    brand string, department string, sku string, distribution_center_id bigint
"""
_ORDERS = """
    order_id bigint, user_id bigint, status string, gender string, num_of_item bigint,
    shipped_at timestamp, delivered_at timestamp, returned_at timestamp, ordered_at timestamp
"""
_ORDER_ITEMS = """
    order_item_id bigint, order_id bigint, user_id bigint, product_id bigint,
    inventory_item_id bigint, status string, sale_price double, shipped_at timestamp,
    delivered_at timestamp, returned_at timestamp, ordered_at timestamp
"""
_DATES = """
    date_day date, year bigint, quarter bigint, month bigint, day bigint, day_of_week bigint,
    day_of_year bigint, year_month string, year_quarter string, is_weekend boolean
"""
_FACT_ITEMS = """
    order_item_id bigint, order_id bigint, user_id bigint, product_id bigint,
    inventory_item_id bigint, ordered_date date, delivered_date date, status string,
    sale_price double, cost double, ordered_at timestamp, shipped_at timestamp,
    delivered_at timestamp, returned_at timestamp, net_revenue double, gross_margin double,
    gross_margin_rate double, is_returned boolean, is_delivered boolean, days_to_delivery bigint
"""
_FACT_ORDERS = """
    order_id bigint, user_id bigint, ordered_date date, delivered_date date, status string,
    gender string, ordered_at timestamp, shipped_at timestamp, delivered_at timestamp,
    returned_at timestamp, items_count bigint, returned_items_count bigint,
    is_fully_returned boolean, is_partially_returned boolean, total_revenue_gross double,
    total_revenue_net double, total_cost double, total_gross_margin double,
    gross_margin_rate double, average_item_price double
"""


class ContractError(ValueError):
    """The columns to be written are not the declared ones."""


@dataclass(frozen=True)
class Contract:
    model: str
    business: tuple[tuple[str, str], ...]
    audited: bool = True
    personal: frozenset[str] = frozenset()  # hashed at staging, still classed as personal
    internal: frozenset[str] = frozenset()
    sensitive: frozenset[str] = frozenset()  # personal data that needs more care than the rest
    classes: tuple[tuple[str, str], ...] = ()  # what an author says of a column goes before all else

    def __post_init__(self) -> None:
        unknown = {kind for _, kind in self.classes} - set(DATA_CLASSES)
        if unknown:
            raise ContractError(f"{self.model}: no data class {', '.join(sorted(unknown))}")

    @property
    def columns(self) -> tuple[tuple[str, str], ...]:
        return self.business + (AUDIT if self.audited else ())

    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.columns)

    def data_class(self, column: str) -> str:
        declared = dict(self.classes).get(column)
        if declared:
            return declared
        if column in self.sensitive:
            return "sensitive_pii"
        if column in self.personal:
            return "pii"
        if column in self.internal or column.startswith("_"):
            return "internal"
        return "public"


def _parse(text: str) -> tuple[tuple[str, str], ...]:
    return tuple((name, kind) for name, kind in (part.split() for part in text.split(",")))


_PERSONAL = frozenset({"first_name", "last_name", "email", "street_address"})
_SENSITIVE = frozenset({"email", "street_address"})  # each alone leads to a person

CONTRACTS = {
    c.model: c
    for c in (
        Contract("stg_users", _parse(_USERS), personal=_PERSONAL, sensitive=_SENSITIVE),
        Contract("stg_products", _parse(_PRODUCTS), internal=frozenset({"cost"})),
        Contract("stg_orders", _parse(_ORDERS)),
        Contract("stg_order_items", _parse(_ORDER_ITEMS)),
        Contract("dim_users", _parse(_USERS), personal=_PERSONAL, sensitive=_SENSITIVE),
        Contract("dim_products", _parse(_PRODUCTS), internal=frozenset({"cost"})),
        Contract("dim_dates", _parse(_DATES), audited=False),
        Contract(
            "fct_order_items",
            _parse(_FACT_ITEMS),
            internal=frozenset({"cost", "gross_margin", "gross_margin_rate"}),
        ),
        Contract(
            "fct_orders",
            _parse(_FACT_ORDERS),
            internal=frozenset({"total_cost", "total_gross_margin", "gross_margin_rate"}),
        ),
    )
}


def differences(df: DataFrame, model: str) -> list[str]:
    """What keeps ``df`` from meeting the contract; empty when it is met."""
    declared = dict(CONTRACTS[model].columns)
    actual = dict(df.dtypes)
    found = [f"missing column {name} {kind}" for name, kind in declared.items() if name not in actual]
    found += [f"extra column {name} {kind}" for name, kind in actual.items() if name not in declared]
    found += [
        f"column {name} is {actual[name]}, declared {kind}"
        for name, kind in declared.items()
        if name in actual and actual[name] != kind
    ]
    if len(df.columns) != len(actual):
        found.append("repeated column name")
    return found


def enforce(df: DataFrame, model: str) -> DataFrame:
    """``df`` in declared column order, or ContractError listing every difference."""
    found = differences(df, model)
    if found:
        raise ContractError(f"{model}: " + "; ".join(found))
    return df.select(*CONTRACTS[model].names())


def contract_report(df: DataFrame, model: str) -> DataFrame:
    """One row per declared or actual column: types side by side and its NULLs.

    The counts of all columns come from one pass and one row per task is shuffled.
    """
    declared = dict(CONTRACTS[model].columns)
    actual = dict(df.dtypes)
    names = [*declared, *(name for name in actual if name not in declared)]
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count(F.col(f"`{name}`")).alias(name) for name in names if name in actual),
    )
    return counted.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(model).alias("model"),
                        F.lit(name).alias("column"),
                        F.lit(declared.get(name)).cast("string").alias("declared_type"),
                        F.lit(actual.get(name)).cast("string").alias("actual_type"),
                        F.lit(declared.get(name) == actual.get(name)).alias("matches"),
                        F.col("_rows").alias("rows"),
                        (
                            F.col("_rows") - F.col(f"`{name}`") if name in actual else F.col("_rows")
                        ).alias("nulls"),
                    )
                    for name in names
                )
            )
        )
    )


def classify(df: DataFrame, model: str) -> DataFrame:
    """Carry each column's data class in the schema, as ``data_class`` metadata."""
    contract = CONTRACTS[model]
    return df.select(
        *(
            F.col(name).alias(name, metadata={"data_class": contract.data_class(name)})
            for name in df.columns
        )
    )


def visible_to(df: DataFrame, classes: set[str]) -> DataFrame:
    """Only the columns whose data class is allowed; an unclassed column is not.

    The other columns are pruned from the scan, so they are not even read.
    """
    return df.select(
        *(f.name for f in df.schema.fields if f.metadata.get("data_class") in classes)
    )


def _classes_of(plan, known: dict[int, str | None]) -> dict[int, str | None]:
    """The class of each attribute that a plan puts out, by the attribute's id.

    A column has the strictest class of all columns it is made from. What a node puts
    out by other means than a named expression (a generator, a Python function) is
    taken to be made from all it reads.
    """

    def items(found) -> list:
        return [found.apply(i) for i in range(found.size())]

    def ids(found) -> list[int]:
        return [a.exprId().id() for a in items(found.toSeq())]

    def strictest(classes: list[str | None]) -> str | None:
        if None in classes:
            return None  # of a column without a class nothing is known
        return max(classes, key=DATA_CLASSES.index, default=DATA_CLASSES[0])

    def declared(attribute) -> str | None:
        metadata = attribute.metadata()
        return metadata.getString("data_class") if metadata.contains("data_class") else None

    def gather(expression) -> None:
        """Classes of the aliases of an expression, inner ones first."""
        for child in items(expression.children()):
            gather(child)
        if expression.getClass().getSimpleName() == "Alias":
            own = declared(expression)
            known[expression.exprId().id()] = own or strictest([known.get(i) for i in ids(expression.child().references())])

    children = items(plan.children())
    for child in children:
        _classes_of(child, known)
    for expression in items(plan.expressions()):
        gather(expression)
    output = items(plan.output())
    if plan.getClass().getSimpleName() == "Union":
        for place, attribute in enumerate(output):
            rows = [items(child.output())[place].exprId().id() for child in children]
            known[attribute.exprId().id()] = strictest([known.get(i) for i in rows])
        return known
    read = [a.exprId().id() for child in children for a in items(child.output())]
    for attribute in output:
        number = attribute.exprId().id()
        if number not in known:
            known[number] = strictest([known.get(i) for i in read]) if children else declared(attribute)
    return known


def inherit(df: DataFrame) -> DataFrame:
    """``df`` with a data class for every column, also those derived from classed ones.

    A derived column takes the strictest class of the columns it comes from, through
    joins, unions, groups, windows and generators; a class declared on the way stands,
    a column without inputs is public, and one with an unclassed input has no class.
    Only the analysed plan is walked; no data is read.
    """
    plan = df._jdf.queryExecution().analyzed()
    known = _classes_of(plan, {})
    output = plan.output()
    classes = [known.get(output.apply(i).exprId().id()) for i in range(output.size())]
    return df.select(
        *(
            F.col(f"`{name}`").alias(name, metadata={"data_class": kind}) if kind else F.col(f"`{name}`")
            for name, kind in zip(df.columns, classes)
        )
    )
