"""Build of all models in dependency order: views stay lazy, marts are written.

Each mart is checked against its contract, written, and read back, so the facts
are computed once and whatever builds on them scans columns of a stored table. The
tests of a model run on what was written, before it is put in force and before
anything is built on it; the last check is that both facts tell the same.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import date
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from martweave.functions.audit import Run
from martweave.operators import dimensions, facts, staging
from martweave.operators.contracts import CONTRACTS, classify, enforce
from martweave.functions.money import UNITS
from martweave.operators import metrics
from martweave.operators.quality import model_tests, parents
from martweave.plans.namespaces import schema_name
from martweave.sources.landed import LandedTable


@dataclass(frozen=True)
class Inputs:
    """What a build is made from; ``raw`` gives the landed rows of a table."""

    spark: SparkSession
    raw: Callable[[str], DataFrame]
    run: Run
    salt: Column
    horizon: date = staging.HORIZON
    calendar_end: date | None = None
    units: float | None = UNITS  # money is counted in; None adds doubles


@dataclass(frozen=True)
class Model:
    layer: str
    needs: tuple[str, ...]
    make: Callable[[Inputs, dict[str, DataFrame]], DataFrame]
    stored: bool = True
    month_of: str | None = None
    key: str = ""


MODELS = {
    "stg_users": Model(
        "staging", (), lambda i, m: staging.stg_users(i.raw("users"), i.run, i.salt), stored=False
    ),
    "stg_products": Model(
        "staging", (), lambda i, m: staging.stg_products(i.raw("products"), i.run), stored=False
    ),
    "stg_orders": Model(
        "staging", (), lambda i, m: staging.stg_orders(i.raw("orders"), i.run), stored=False
    ),
    "stg_order_items": Model(
        "staging",
        (),
        lambda i, m: staging.stg_order_items(i.raw("order_items"), i.run, i.horizon),
        stored=False,
    ),
    "dim_users": Model(
        "marts",
        ("stg_users",),
        lambda i, m: dimensions.dim_users(m["stg_users"], i.run),
        key="user_id",
    ),
    "dim_products": Model(
        "marts",
        ("stg_products",),
        lambda i, m: dimensions.dim_products(m["stg_products"], i.run),
        key="product_id",
    ),
    "dim_dates": Model(
        "marts",
        (),
        lambda i, m: dimensions.dim_dates(dimensions.date_spine(i.spark, i.horizon, i.calendar_end)),
        key="date_day",
    ),
    "fct_order_items": Model(
        "marts",
        ("stg_order_items", "dim_products"),
        lambda i, m: facts.fct_order_items(m["stg_order_items"], m["dim_products"], i.run),
        month_of="ordered_date",
        key="order_item_id",
    ),
    "fct_orders": Model(
        "marts",
        ("fct_order_items", "stg_orders"),
        lambda i, m: facts.fct_orders(m["fct_order_items"], m["stg_orders"], i.run, i.units),
        month_of="ordered_date",
        key="order_id",
    ),
}


_TEST_COLUMNS = ("model", "column", "test", "failures", "severity")
TEST = "model string, column string, test string, failures bigint, severity string"


class TestsFailed(RuntimeError):
    """Data tests of severity error found violations: ``results``, one row per test."""

    __test__ = False  # not a test class

    def __init__(self, results: list[Row]):
        self.results = results
        super().__init__("; ".join(f"{r.test} {r.model}.{r.column}: {r.failures}" for r in results))


def _raise(results: list[Row]) -> None:
    failed = [r for r in results if r.severity == "error" and r.failures]
    if failed:
        raise TestsFailed(failed)


@dataclass
class Built:
    """The models, and the results of their tests: one row per declared test, counted once."""

    models: dict[str, DataFrame] = field(default_factory=dict)
    tests: DataFrame | None = None

    def register(self) -> None:
        """Make every model a view of its own name, for ``spark.sql``."""
        for name, df in self.models.items():
            df.createOrReplaceTempView(name)

    def raise_on_failure(self) -> None:
        _raise(self.tests.collect())


def coherent_facts(models: dict[str, DataFrame], units: float | None = UNITS) -> DataFrame:
    """Countries in which the two facts differ, for each metric that both have.

    Items whose order is not there belong to one fact only and are left out; they
    are what ``fk_orphans`` lists.
    """
    names, by = ["net_revenue", "gross_margin", "items"], ["country"]
    lookup = (metrics.Lookup(models["dim_users"], "user_id", "user_id", ("country",)),)
    orders = models["fct_orders"]
    items = models["fct_order_items"].join(orders.select("order_id"), "order_id", "left_semi")
    compared = metrics.coherence(
        metrics.measure(items, "fct_order_items", names, by, lookup, units),
        metrics.measure(orders, "fct_orders", names, by, lookup, units),
        by,
        names,
        0.0 if units else 1e-6,
    )
    return compared.groupBy(F.col("metric").alias("column")).agg(
        F.count_if(~F.col("coherent")).alias("failures")
    ).select(
        F.lit("fct_orders").alias("model"),
        "column",
        F.lit("coherence:fct_order_items").alias("test"),
        "failures",
        F.lit("error").alias("severity"),
    )


def lazy_models(inputs: Inputs, wanted: tuple[str, ...] = tuple(MODELS)) -> dict[str, DataFrame]:
    """The wanted models and what they need, as plans over the raw tables."""
    models: dict[str, DataFrame] = {}

    def add(name: str) -> None:
        if name not in models:
            for need in MODELS[name].needs:
                add(need)
            models[name] = MODELS[name].make(inputs, models)

    for name in wanted:
        add(name)
    return models


def mart(spark: SparkSession, place: str, name: str) -> LandedTable:
    model = MODELS[name]
    return LandedTable(
        spark,
        f"{place}/{name}",
        CONTRACTS[name].ddl(),
        [model.key],
        month_of=model.month_of,
        stamped=False,
    )


def build(
    inputs: Inputs,
    root: str,
    environment: str = "dev",
    base: str = "analytics",
    workers: int = 4,
    deferred_tests: bool = False,
    gate: bool = True,
) -> Built:
    """Build and test every model under ``root``.

    Models that do not need each other are submitted side by side. A model whose
    tests of severity error fail raises TestsFailed: it is not put in force, and
    nothing is built on it. With ``gate`` off all is built and the results tell. A
    stored model that is in already for this run id is not written again, so a build
    that died half-way is finished by running it again under its run id.
    """
    tested = {name: parents(name, deferred_tests) for name in MODELS}
    graph = TopologicalSorter({name: {*model.needs, *tested[name]} for name, model in MODELS.items()})
    graph.prepare()
    built: dict[str, DataFrame] = {}
    results: list[Row] = []

    def passed(found: DataFrame | None) -> None:
        rows = found.collect() if found is not None else []  # one per test
        results.extend(rows)
        if gate:
            _raise(rows)

    def check(name: str, df: DataFrame) -> None:
        passed(model_tests(name, {p: built[p] for p in tested[name]} | {name: df}, deferred_tests))

    def make(name: str) -> tuple[str, DataFrame]:
        model = MODELS[name]
        df = classify(enforce(model.make(inputs, built), name), name)
        if model.stored:
            place = f"{root.rstrip('/')}/{schema_name(environment, base, model.layer)}"
            table = mart(inputs.spark, place, name)
            if table.has(inputs.run.run_id):
                check(name, table.read())
            else:
                table.replace(df, inputs.run.run_id, lambda rows, _: check(name, rows))
            df = classify(table.read(), name)
        else:
            check(name, df)
        return name, df

    with ThreadPoolExecutor(workers) as pool:
        running = set()
        while graph.is_active():
            running |= {pool.submit(make, name) for name in graph.get_ready()}
            done, running = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                name, df = future.result()
                built[name] = df
                graph.done(name)
    passed(coherent_facts(built, inputs.units))
    return Built(built, inputs.spark.createDataFrame([tuple(r[c] for c in _TEST_COLUMNS) for r in results], TEST))
