"""What the physical plans must and must not hold, as they will run on large tables."""

from __future__ import annotations

import re

import pytest
from support import plan, values
from pyspark.sql import functions as F

import __spark_entry__ as entry
from martweave.operators import facts, ingest, quality

STORED = {"landed_upsert", "ingest_stream", "ingest_run", "build_run"}  # these run jobs of their own
LAZY = [name for name in entry.plain_queries() if name not in STORED]


def physical(df) -> str:
    text = plan(df)
    return text[text.index("== Physical Plan ==") :]


@pytest.mark.parametrize("name", LAZY)
def test_no_pairs_and_no_python(spark, folder, name):
    text = physical(entry.queries()[name](spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "SinglePartition, REPARTITION"):
        assert bad not in text
    # A single partition is for final sums only: one row per task comes in.
    for line in text.splitlines():
        if "Window [" in line:
            assert re.search(r"\], \[\w+#", line), line


@pytest.mark.parametrize(
    "name, column",
    [
        ("ingest_orders_incremental", "o_orderdate"),
        ("ingest_order_items_incremental", "l_shipdate"),
        ("fct_order_items", "l_shipdate"),
        ("star_month_country", "l_shipdate"),
        ("metric_net_revenue_by_month", "l_shipdate"),
    ],
)
def test_time_bound_reaches_the_scan(spark, folder, name, column):
    assert f"GreaterThanOrEqual({column}," in physical(entry.queries()[name](spark, folder))


@pytest.mark.parametrize(
    "name, read",
    [
        ("net_revenue", {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"}),
        ("metric_net_revenue_by_month", {"l_extendedprice", "l_returnflag", "l_shipdate"}),
        ("metric_conversion", {"ts", "user_id", "event_type"}),
        ("dim_products", {"p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"}),
    ],
)
def test_only_used_columns_are_read(spark, folder, name, read):
    schemas = re.findall(r"ReadSchema: struct<(.*)>", physical_full(spark, entry.queries()[name](spark, folder)))
    assert {c.split(":")[0] for s in schemas for c in s.split(",")} == read


def physical_full(spark, df) -> str:
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return physical(df.select("*"))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)


@pytest.mark.parametrize(
    "name, scans",
    [
        ("dq_unique", {"lineitem": 3, "orders": 2, "part": 4, "customer": 2}),
        ("dq_not_null", {"lineitem": 3, "orders": 3, "part": 4, "customer": 2}),
        ("dq_relationships", {"lineitem": 3, "orders": 3}),
        ("contract_report", {"lineitem": 4, "orders": 4}),
    ],
)
def test_tests_scan_a_table_once_for_each_model_and_key(spark, folder, name, scans):
    """One scan for each model that needs the table; the calendar looks at lineitem once more."""
    text = physical_full(spark, entry.queries()[name](spark, folder))
    for table, most in scans.items():
        found = len(re.findall(rf"FileScan parquet .*?/{table}\.parquet", text))
        more = table == "lineitem" and name != "dq_relationships"
        assert found <= most + more, (table, found)


def test_star_query_joins_rows_in_one_shuffle_less(spark, folder, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    c = entry.Context(spark, folder)
    star = physical(entry.queries()["star_month_country"](spark, folder))

    def summed(first):
        country = entry.metrics.Lookup(c.users(), "user_id", "user_id", ("country",), sum_first=first)
        return physical(
            entry.metrics.measure(
                c.measured_items("user_id"), "fct_order_items", ["net_revenue", "gross_margin", "items"],
                ["year_month", "country"], (entry.by_month(c), country),
            )
        )

    assert star.count("Exchange hash") == summed(False).count("Exchange hash") < summed(True).count("Exchange hash")


def test_order_fact_shuffles_items_once(spark, folder, conf):
    """By shuffle, the totals stay where the aggregation left them."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    items = spark.range(10).select(
        F.col("id").alias("order_id"),
        *(F.lit(1.0).alias(c) for c in ("sale_price", "net_revenue", "cost", "gross_margin")),
        F.lit(True).alias("is_returned"),
    )
    orders = entry.Context(spark, folder).orders()
    joined = facts.with_order_attributes(facts.order_totals(items), orders)
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", physical(joined))) == 2


@pytest.mark.parametrize("name", ["fct_order_items", "fct_orders", "star_month_country", "merge_upsert", "dq_relationships", "fk_orphans"])
def test_same_rows_without_any_automatic_broadcast(spark, folder, conf, name):
    run = entry.queries()[name]
    expected = values(run(spark, folder), "*")
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    got = run(spark, folder)
    assert "SortMergeJoin" in physical(got)
    assert values(got, "*") == expected


def skewed(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


@pytest.mark.parametrize("hot", ["7", "null"])
def test_a_best_seller_is_split_among_tasks(spark, conf, hot):
    """A third of all items have one product, or none; the left join shares them out."""
    skewed(conf)
    items = spark.range(0, 300_000, 1, 8).select(
        F.col("id").alias("order_item_id"),
        F.expr(f"if(id % 3 = 0, {hot}, id % 5000)").alias("product_id"),
    )
    products = spark.range(0, 5000).select(F.col("id").alias("product_id"), F.col("id").cast("double").alias("cost"))
    joined = facts.with_cost(items, products)
    checked = joined.withColumn("x", F.xxhash64("order_item_id", "cost"))
    assert checked.count() == 300_000
    checked.write.format("noop").mode("overwrite").save()
    counted = joined.filter("cost is null").count()
    assert counted == (100_000 if hot == "null" else 0)
    stored = joined.select("*")
    stored.collect()
    assert "skew=true" in physical(stored)


def test_hot_groups_are_reduced_before_the_shuffle(spark):
    """One row per key and task is shuffled, however many copies there are."""
    rows = spark.range(0, 200_000, 1, 8).select(
        F.expr("if(id % 3 = 0, 1, id % 100)").alias("order_id"), F.col("id").alias("v")
    )
    latest = ingest.latest_per_key(rows, ["order_id"], ["v"])
    repeats = quality.repeated_keys(rows, "order_id")
    for df in (latest, repeats):
        df.collect()
        written = shuffled_rows(df)
        assert written and max(written) <= 8 * 100


def shuffled_rows(df) -> list[int]:
    """Rows each exchange of the executed plan wrote."""
    found = []

    def visit(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            visit(node.executedPlan())
            return
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            visit(node.plan())
            return
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            found.append(node.metrics().get("shuffleRecordsWritten").get().value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return found
