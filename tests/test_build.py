from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timezone

import pytest
from support import plan as plan_of
from support import values
from pyspark.sql import functions as F

import __spark_entry__ as entry
from martweave.functions.audit import Run
from martweave.functions.privacy import salt_column
from martweave.operators import metrics
from martweave.operators.contracts import CONTRACTS, ContractError
from martweave.plans import build as plan
from martweave.plans.catalog import catalogue
from martweave.plans.namespaces import schema_name


@pytest.mark.parametrize(
    "environment, custom, name",
    [
        ("prod", "marts", "marts"),
        ("prod", " marts ", "marts"),
        ("prod", None, "base"),
        ("dev", "marts", "base_marts"),
        ("ci", " staging ", "base_staging"),
        ("dev", None, "base"),
    ],
)
def test_schema_name(environment, custom, name):
    assert schema_name(environment, "base", custom) == name


def test_every_need_is_a_model_and_there_is_no_cycle():
    from graphlib import TopologicalSorter

    order = list(TopologicalSorter({n: m.needs for n, m in plan.MODELS.items()}).static_order())
    assert set(order) == set(plan.MODELS) == set(CONTRACTS)
    assert order.index("stg_order_items") < order.index("fct_order_items") < order.index("fct_orders")


def inputs(spark, tables, run):
    def raw(name):
        return tables.order_items(since=entry.HORIZON_AT) if name == "order_items" else getattr(tables, name)()

    return plan.Inputs(spark, raw, run, salt_column(spark, "s"), entry.HORIZON, date(2002, 7, 1))


@pytest.fixture(scope="module")
def built(spark, folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("marts"))
    run = Run("run-1", datetime(2024, 1, 1, tzinfo=timezone.utc))
    made = inputs(spark, entry.OrderTables(spark, folder), run)
    return root, made, plan.build(made, root, deferred_tests=True, gate=False)


def test_marts_hold_what_the_plans_say(spark, built):
    root, made, result = built
    lazy = plan.lazy_models(made)
    for name in ("dim_users", "dim_products", "dim_dates", "fct_order_items", "fct_orders"):
        stored = plan.mart(spark, f"{root}/analytics_marts", name).read()
        assert stored.columns == CONTRACTS[name].names()
        assert stored.count() == lazy[name].count()
        assert stored.exceptAll(lazy[name]).count() == 0
        assert lazy[name].exceptAll(stored).count() == 0


def test_audit_columns_are_those_of_the_run(built):
    _, _, result = built
    for name in ("dim_users", "fct_orders"):
        assert values(result.models[name].distinct(), "_run_id")[0] == ("run-1",)


def test_all_declared_tests_run(built):
    _, _, result = built
    hard = result.tests.filter("severity = 'error'")
    assert hard.count() == 30 + 3  # the declared ones and the facts' coherence
    # The smallest tables hold one line twice; nothing else fails.
    failed = values(hard.filter("failures > 0"), "model", "test", "failures")
    assert failed == [("fct_order_items", "unique", 1), ("stg_order_items", "unique", 1)]
    with pytest.raises(plan.TestsFailed, match="unique fct_order_items.order_item_id: 1"):
        result.raise_on_failure()
    soft = {(r.model, r.column): r.failures for r in result.tests.filter("severity = 'warn'").collect()}
    assert soft["stg_users", "email"] in (0, 15) and len(soft) >= 7


def test_item_and_order_revenue_agree(built):
    _, _, result = built
    items = result.models["fct_order_items"].agg(entry.metrics.from_parts(*sums("net_revenue"))).first()[0]
    orders = result.models["fct_orders"].agg(entry.metrics.from_parts(*sums("total_revenue_net"))).first()[0]
    assert items == orders


def sums(column):
    return [make() for make in entry.metrics.summed_parts("x", column).values()]


def test_models_are_open_to_sql(spark, built):
    _, _, result = built
    result.register()
    got = spark.sql(
        """SELECT d.year_quarter, sum(f.items_count) AS n FROM fct_orders f
           JOIN dim_dates d ON d.date_day = f.ordered_date GROUP BY 1"""
    )
    assert got.count() > 20


def test_building_again_under_the_same_run_writes_nothing(spark, built):
    root, made, _ = built
    mart = plan.mart(spark, f"{root}/analytics_marts", "fct_orders")
    files = sorted(mart.read().inputFiles())
    plan.build(made, root, gate=False)
    assert sorted(mart.read().inputFiles()) == files and mart.loads().count() == 1


def test_marts_are_read_by_month(spark, built):
    root, _, _ = built
    mart = plan.mart(spark, f"{root}/analytics_marts", "fct_order_items")
    march = mart.read(date(1997, 3, 1), date(1997, 4, 1))
    assert "PartitionFilters: [isnotnull(partition_month" in plan_of(march)
    assert march.count() == mart.read().filter("date_trunc('month', ordered_date) = '1997-03-01'").count()


def test_a_model_that_breaks_its_contract_is_not_written(spark, folder, tmp_path, monkeypatch):
    tables = entry.OrderTables(spark, folder)
    model = plan.MODELS["dim_products"]
    broken = plan.Model(model.layer, model.needs, lambda i, m: model.make(i, m).drop("sku"), key=model.key)
    monkeypatch.setitem(plan.MODELS, "dim_products", broken)
    with pytest.raises(ContractError, match="missing column sku"):
        plan.build(inputs(spark, tables, Run("r")), str(tmp_path))
    assert plan.mart(spark, f"{tmp_path}/analytics_marts", "dim_products").is_new()


def test_a_repeated_product_stops_the_build_before_anything_hangs_on_it(spark, folder, tmp_path):
    tables = entry.OrderTables(spark, folder)
    made = inputs(spark, tables, Run("r"))

    def raw(name):
        rows = made.raw(name)
        return rows.unionByName(rows.limit(1)) if name == "products" else rows

    with pytest.raises(plan.TestsFailed, match="unique stg_products.product_id: 1"):
        plan.build(replace(made, raw=raw), str(tmp_path))
    for name in ("dim_products", "fct_order_items", "fct_orders"):
        assert plan.mart(spark, f"{tmp_path}/analytics_marts", name).is_new()


def test_a_mart_that_fails_its_tests_leaves_the_old_one_in_force(spark, folder, tmp_path, monkeypatch):
    made = inputs(spark, entry.OrderTables(spark, folder), Run("r"))
    table = plan.mart(spark, str(tmp_path), "dim_products")
    rows = plan.lazy_models(made, ("dim_products",))["dim_products"]
    table.replace(rows, "one")

    def refuse(*_):
        raise plan.TestsFailed([])

    with pytest.raises(plan.TestsFailed):
        table.replace(rows.limit(1), "two", refuse)
    assert table.loads().count() == 1 and table.read().count() == rows.count()


def test_facts_that_differ_are_found(spark, built):
    _, _, result = built
    assert {r.failures for r in plan.coherent_facts(result.models).collect()} == {0}
    changed = result.models["fct_orders"].withColumn("total_revenue_net", F.col("total_revenue_net") + (F.col("user_id") == 1).cast("int"))
    failed = {r.column: r.failures for r in plan.coherent_facts({**result.models, "fct_orders": changed}).collect()}
    assert failed["net_revenue"] <= 1 and failed["items"] == 0


def test_units_of_money_reach_the_facts(spark, folder, tmp_path):
    made = inputs(spark, entry.OrderTables(spark, folder), Run("r"))
    whole = plan.lazy_models(replace(made, units=1.0), ("fct_orders",))["fct_orders"]
    assert whole.filter("total_revenue_gross != floor(total_revenue_gross)").isEmpty()


def test_a_filtered_calendar_prunes_the_months_of_a_stored_fact(spark, built):
    root, _, result = built
    stored = plan.mart(spark, f"{root}/analytics_marts", "fct_order_items")
    calendar = result.models["dim_dates"].filter("year = 1997 AND quarter = 2")
    lookup = metrics.Lookup(calendar, "ordered_date", "date_day", ("year_month",), calendar=True, only=True, month="year_month")
    names = ["net_revenue", "items", "p90_delivery_days"]
    got = metrics.measure(stored.by_month(), "fct_order_items", names, ["year_month"], (lookup,))
    assert "dynamicpruning" in plan_of(got)
    direct = stored.read().filter("ordered_date >= '1997-04-01' AND ordered_date < '1997-07-01'")
    want = metrics.measure(
        direct.withColumn("year_month", F.date_format("ordered_date", "yyyy-MM")), "fct_order_items", names, ["year_month"]
    )
    assert values(got, "*") == values(want, "*") and got.count() == 3


def test_models_lie_in_the_catalog_by_environment(spark, built):
    root, _, result = built
    for _ in range(2):
        names = catalogue(spark, root)
    assert "analytics_marts.fct_orders" in names and len(names) == 5
    months = spark.sql("SELECT count(*) AS n FROM analytics_marts.fct_order_items WHERE partition_month = '1997-03'")
    assert "PartitionFilters: [isnotnull(partition_month" in plan_of(months)
    assert months.first().n == result.models["fct_order_items"].filter("date_format(ordered_date, 'yyyy-MM') = '1997-03'").count() > 0
    open_columns = spark.sql("SELECT * FROM analytics_marts.dim_users_public").columns
    assert "country" in open_columns and "email" not in open_columns and "partition_month" not in open_columns
    spark.sql("DROP DATABASE analytics_marts CASCADE")
    assert plan.mart(spark, f"{root}/analytics_marts", "fct_orders").read().count() > 0  # only the names went
