from __future__ import annotations

from datetime import date

import pytest
from support import plan, values
from pyspark.sql import functions as F

from martweave.operators import contracts, metrics, quality


def test_declared_tests_count():
    assert sum(map(len, quality.NOT_NULL.values())) == 19
    assert len(quality.UNIQUE) == 9
    assert len(quality.RELATIONSHIPS) == 2


def test_not_null_and_unique(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (None, None), (None, 3)], "a int, b int")
    assert values(quality.not_null(df, "m", ("a", "b")), "column", "failures") == [("a", 2), ("b", 2)]
    # NULL keys are no repeats.
    assert quality.unique(df, "m", "a").first().failures == 1
    assert quality.unique(df, "m", "b").first().failures == 0
    assert quality.unique(df.limit(0), "m", "a").first().failures == 0


def test_relationship_ignores_null(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert values(quality.orphans(child, "k", parent, "id"), "k", "rows") == [(9, 2)]
    r = quality.Relationship("c", "k", "p", "id")
    got = quality.relationship({"c": child, "p": parent}, r).first()
    assert (got.model, got.test, got.failures) == ("c", "relationships:p.id", 2)


def test_relationships_together_are_those_alone(spark):
    import random

    draw = random.Random(2)
    child = spark.createDataFrame(
        [(draw.choice([None, *range(30)]), draw.choice(["a", "b", "z", None])) for _ in range(300)], "k int, s string"
    )
    other = spark.createDataFrame([(k % 9,) for k in range(40)], "k bigint")
    models = {
        "c": child, "o": other, "p": spark.createDataFrame([(k,) for k in range(0, 30, 2)] + [(None,)], "id bigint"),
        "q": spark.createDataFrame([("a",), ("b",)], "s string"), "empty": spark.createDataFrame([], "id int"),
    }
    tests = [
        quality.Relationship("c", "k", "p", "id"), quality.Relationship("c", "s", "q", "s"), quality.Relationship("o", "k", "p", "id"),
        quality.Relationship("c", "k", "empty", "id"), quality.Relationship("o", "k", "o", "k"),
    ]
    alone = [quality.relationship(models, r).first() for r in tests]
    assert values(quality.relationships(models, tests), "*") == sorted(map(tuple, alone), key=repr)
    text = plan(quality.relationships({**models, "c": child.repartition(3)}, tests))
    assert text[text.index("== Physical Plan ==") :].count("REPARTITION_BY_NUM") == 1  # the child is read once


def test_each_child_is_counted_in_a_stage_of_its_own(spark):
    """Not stacked with others below the shuffle, where a child of few bytes gets few tasks for its rows."""
    models = {n: spark.range(9).select((F.col("id") % m).alias("k")) for n, m in (("a", 2), ("b", 3), ("p", 4))}
    tests = [quality.Relationship("a", "k", "p", "k"), quality.Relationship("b", "k", "p", "k")]
    found = quality.relationships(models, tests)
    text = plan(found)
    stacked = text[text.index("== Physical Plan ==") :].split(" Union", 1)[1]
    assert stacked.count("Exchange hashpartitioning(_parent") == stacked.count("partial_count") == 2
    assert [r.failures for r in found.collect()] == [0, 0]


def test_uniqueness_together_is_that_alone(spark):
    a = spark.createDataFrame([(1, date(2024, 1, 1)), (1, date(2024, 1, 2)), (None, date(2024, 1, 1)), (None, None)], "k int, d date")
    b = spark.createDataFrame([("x",), ("x",), ("1",), (None,)], "s string")
    models = {"a": a, "b": b, "none": a.limit(0)}
    for tests in ([("a", "k"), ("a", "d"), ("none", "k")], [("a", "k"), ("b", "s"), ("a", "d")]):
        alone = sorted(tuple(quality.unique(models[m], m, c).first()) for m, c in tests)
        assert values(quality.uniques(models, tests), "model", "column", "test", "failures") == alone


def test_uniqueness_of_a_load(spark, conf):
    rows = [(1, "one"), (2, "one"), (None, "one"), (3, None), (2, "two"), (3, "two"), (4, "two"), (4, "two"), (None, "two"), (5, "two")]
    table = spark.createDataFrame(rows, "id int, _load_id string")
    for small in ("10MB", "-1"):
        conf(spark__sql__autoBroadcastJoinThreshold=small)
        assert values(quality.repeated_in_load(table, "id", "two"), "id") == [(2,), (3,), (4,)]
        assert quality.unique_in_load(table, "t", "id", "two").first().failures == 3
    assert quality.unique_in_load(table, "t", "id", "none").first().failures == 0
    assert quality.unique_in_load(table.limit(0), "t", "id", "two").first().failures == 0


def test_a_bloom_filter_of_the_load_reaches_the_scan_of_a_large_table(spark, tmp_path, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0",
    )
    path = str(tmp_path / "t")
    spark.range(50_000).select("id", F.expr("IF(id >= 49000, 'new', 'old')").alias("_load_id")).write.parquet(path)
    found = quality.repeated_in_load(spark.read.parquet(path), "id", "new")
    assert "might_contain" in plan(found) and found.count() == 0


def test_orphans_by_day(spark):
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    child = spark.createDataFrame([(9, d1), (9, d1), (8, d1), (8, d2), (1, d2)], "k int, d date")
    parent = spark.createDataFrame([(1,)], "id int")
    got = quality.orphans_by_day(child, "k", parent, "id", "d")
    assert values(got, "d", "orphan_keys", "orphan_rows") == [(d1, 2, 3), (d2, 1, 1)]


def test_accepted_values(spark):
    df = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "s string")
    assert values(quality.value_counts(df, "m", "s", ("a", "b")), "value", "rows", "accepted") == [
        ("a", 2, True),
        ("z", 1, False),
    ]
    assert quality.accepted_values(df, "m", "s", ("a", "b")).first().failures == 1
    assert quality.accepted_values(df, "m", "s", ("a", "z")).first().failures == 0


DIM = ", ".join(f"{n} {k}" for n, k in contracts.CONTRACTS["dim_dates"].columns)


def test_contract_drift_is_listed(spark):
    df = spark.createDataFrame([], DIM)
    assert contracts.enforce(df, "dim_dates").columns == contracts.CONTRACTS["dim_dates"].names()
    drifted = df.drop("day").withColumn("more", F.lit(1)).withColumn("year", F.col("year").cast("int"))
    with pytest.raises(contracts.ContractError) as refused:
        contracts.enforce(drifted, "dim_dates")
    for part in ("missing column day bigint", "extra column more int", "year is int, declared bigint"):
        assert part in str(refused.value)
    report = contracts.contract_report(drifted, "dim_dates")
    assert values(report.filter("not matches or matches is null"), "column") == [("day",), ("more",), ("year",)]


def test_enforce_restores_the_declared_order(spark):
    df = spark.createDataFrame([], DIM)
    turned = df.select(*reversed(df.columns))
    assert contracts.enforce(turned, "dim_dates").columns == df.columns


def test_classes_travel_with_the_schema(spark):
    users = spark.createDataFrame([], contracts.CONTRACTS["dim_users"].ddl())
    classed = contracts.classify(users, "dim_users")
    assert "email" not in contracts.visible_to(classed, {"public"}).columns
    assert "_run_id" not in contracts.visible_to(classed, {"public"}).columns
    personal = contracts.visible_to(classed.filter("age > 1"), {"public", "pii"}).columns
    assert "first_name" in personal and "email" not in personal
    assert "email" in contracts.visible_to(classed, {"sensitive_pii"}).columns
    assert contracts.visible_to(users, {"public"}).columns == []


def test_an_author_may_class_a_column():
    own = contracts.Contract("m", (("a", "int"), ("b", "int")), classes=(("a", "sensitive_pii"),))
    assert (own.data_class("a"), own.data_class("b")) == ("sensitive_pii", "public")
    with pytest.raises(contracts.ContractError, match="no data class secret"):
        contracts.Contract("m", (("a", "int"),), classes=(("a", "secret"),))


# --- metrics --------------------------------------------------------------


@pytest.fixture
def facts_and_users(spark):
    items = spark.createDataFrame(
        [
            (1, 10, 100.0, 60.0, False, 2),
            (1, 10, 0.0, -40.0, True, None),
            (2, 10, 50.5, None, False, 4),
            (3, 99, 7.25, 1.0, False, 1),
            (None, 10, 1.0, 1.0, False, 1),
        ],
        "user_id int, product_id int, net_revenue double, gross_margin double, is_returned boolean, "
        "days_to_delivery bigint",
    ).withColumn("ordered_date", F.lit(date(2024, 1, 5)))
    users = spark.createDataFrame([(1, "x"), (2, "x")], "user_id int, country string")
    return items, users


def test_measure_keeps_rows_without_a_dimension(facts_and_users):
    items, users = facts_and_users
    lookup = metrics.Lookup(users, "user_id", "user_id", ("country",))
    got = metrics.measure(
        items,
        "fct_order_items",
        ["net_revenue", "gross_margin", "items", "return_rate", "avg_delivery_days"],
        ["country"],
        (lookup,),
    )
    assert values(got, *got.columns) == [
        ("x", 150.5, 20.0, 3, 1 / 3, 3.0),
        (None, 8.25, 2.0, 2, 0.0, 1.0),
    ]


def test_measure_is_the_same_with_and_without_the_early_sum(facts_and_users):
    items, users = facts_and_users
    names = ["net_revenue", "items", "return_rate"]
    early, late = (
        metrics.measure(
            items,
            "fct_order_items",
            names,
            ["country", "ordered_date"],
            (metrics.Lookup(users, "user_id", "user_id", ("country",), sum_first=first),),
        )
        for first in (True, False)
    )
    assert values(early, "*") == values(late, "*")


def test_measure_of_everything(facts_and_users):
    items, _ = facts_and_users
    got = metrics.measure(items, "fct_order_items", ["net_revenue", "items"], [])
    assert values(got, "net_revenue", "items") == [(158.75, 5)]


def test_dates_outside_the_calendar_are_kept(spark, facts_and_users):
    items, _ = facts_and_users
    calendar = spark.createDataFrame([(date(2025, 1, 1), "2025-01")], "date_day date, year_month string")
    lookup = metrics.Lookup(calendar, "ordered_date", "date_day", ("year_month",), calendar=True)
    got = metrics.measure(items, "fct_order_items", ["items"], ["year_month"], (lookup,))
    assert values(got, "year_month", "items") == [(None, 5)]


def test_delivery_days(facts_and_users):
    items, _ = facts_and_users
    got = metrics.delivery_days(items, ["ordered_date"])
    assert values(got, "delivered_items", "avg_days", "p50_days") == [(4, 2.0, 1.5)]


def test_conversion(spark):
    events = spark.createDataFrame(
        [(1, "view"), (1, "purchase"), (1, "purchase"), (2, "view"), (None, "purchase")],
        "user_id int, event_type string",
    ).withColumn("g", F.lit("all"))
    got = metrics.conversion_rate(events, ["g"])
    assert values(got, "users", "converted_users", "conversion_rate") == [(2, 1, 0.5)]


def random_items(spark, n=4000, seed=3):
    import random

    draw = random.Random(seed)
    data = [
        (draw.choice([None, *range(60)]) if k % 3 else 7, draw.choice([None, None, *range(30)]), date(2024, draw.randint(1, 3), 5))
        for k in range(n)
    ]
    items = spark.createDataFrame(data, "user_id int, days_to_delivery bigint, ordered_date date")
    countries = spark.createDataFrame([(u, f"c{u % 4}") for u in range(50)], "user_id int, country string")
    return data, items.withColumns({"net_revenue": F.lit(1.5), "is_returned": F.lit(False)}), countries


@pytest.mark.parametrize("sum_first", [True, False])
@pytest.mark.parametrize("by", [["country", "ordered_date"], ["country"], []])
def test_percentiles_and_users_over_any_dimension(spark, sum_first, by):
    import numpy as np

    data, items, countries = random_items(spark)
    lookup = metrics.Lookup(countries, "user_id", "user_id", ("country",), sum_first=sum_first)
    names = ["items", "p50_delivery_days", "p90_delivery_days", "buyers", "avg_delivery_days"]
    got = metrics.measure(items, "fct_order_items", names, by, (lookup,))
    groups = {}
    for user, days, day in data:
        country = f"c{user % 4}" if user is not None and user < 50 else None
        key = tuple({"country": country, "ordered_date": day}[c] for c in by)
        groups.setdefault(key, []).append((user, days))
    want = []
    for key, rows in groups.items():
        days = [d for _, d in rows if d is not None]
        users = {u for u, _ in rows if u is not None}
        want.append((*key, len(rows), *(float(np.quantile(days, q)) for q in (0.5, 0.9)), len(users), sum(days) / len(days)))
    near = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in want]
    seen = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in values(got, *by, *names)]
    assert seen == sorted(near, key=repr)


def test_conversion_over_a_dimension(spark):
    events = spark.createDataFrame(
        [(1, "view"), (1, "purchase"), (2, "view"), (2, "view"), (3, "purchase"), (None, "purchase"), (9, "view")],
        "user_id int, event_type string",
    )
    users = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "user_id int, country string")
    names = ["events", "users", "converted_users", "conversion_rate"]
    for first in (True, False):
        lookup = metrics.Lookup(users, "user_id", "user_id", ("country",), sum_first=first)
        got = metrics.measure(events, "events", names, ["country"], (lookup,))
        assert values(got, "country", *names) == [("x", 4, 2, 1, 0.5), ("y", 1, 1, 1, 1.0), (None, 2, 1, 0, 0.0)]
    nobody = metrics.measure(events.filter("user_id IS NULL"), "events", names, [])
    assert values(nobody, *names) == [(1, 0, 0, None)]


def test_sketches_are_near_and_merge(spark):
    events = spark.range(60_000).select(
        F.expr("IF(id % 3 = 0, 5, id % 20000)").alias("user_id"), F.expr("IF(id % 5 = 0, 'purchase', 'view')").alias("event_type"),
        F.expr("CAST(id % 7 AS STRING)").alias("g"),
    )
    lookup = metrics.Lookup(spark.range(20_000).select(F.col("id").alias("user_id"), F.lit("all").alias("country")), "user_id", "user_id", ("country",))
    names = ["users", "users_sketched", "conversion_rate", "conversion_rate_sketched"]
    row = metrics.measure(events, "events", names, ["country"], (lookup,)).first()
    assert abs(row.users_sketched / row.users - 1) < 0.08
    assert abs(row.conversion_rate_sketched / row.conversion_rate - 1) < 0.16
    _, items, countries = random_items(spark, 6000)
    lookup = metrics.Lookup(countries, "user_id", "user_id", ("country",))
    names = ["p50_delivery_days", "p50_delivery_days_sketched", "p99_delivery_days", "p99_delivery_days_sketched"]
    for row in metrics.measure(items, "fct_order_items", names, ["country"], (lookup,)).collect():
        assert abs(row[1] - row[2]) <= 1 and abs(row[3] - row[4]) <= 1
    none = metrics.measure(items.filter("days_to_delivery IS NULL"), "fct_order_items", names, [])
    assert values(none, *names) == [(None, None, None, None)]


def test_coherence(spark):
    ddl = "g string, m double"
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None), (None, 4.0)], ddl)
    right = spark.createDataFrame([("a", 1.0), ("b", 2.5), ("c", None), (None, 4.0), ("d", None)], ddl)
    got = metrics.coherence(left, right, ["g"], ["m"])
    assert {r.g: r.coherent for r in got.collect()} == {"a": True, "b": False, "c": True, None: True, "d": False}
    loose = metrics.coherence(left, right, ["g"], ["m"], tolerance=0.5)
    assert loose.filter("g = 'b'").first().coherent is True


def test_derived_columns_inherit_the_strictest_class(spark):
    ddl = "user_id bigint, first_name string, email string, country string, age bigint"
    plain = spark.createDataFrame([(1, "a", "e", "x", 3)], ddl)
    users = contracts.classify(plain, "dim_users")
    costs = contracts.classify(spark.createDataFrame([(1, 2.0, "b")], "product_id bigint, cost double, brand string"), "dim_products")

    def kinds(df):
        return {f.name: f.metadata.get("data_class") for f in contracts.inherit(df).schema.fields}

    assert kinds(users) == {"user_id": "public", "first_name": "pii", "email": "sensitive_pii", "country": "public", "age": "public"}
    made = users.select(
        F.concat("country", "first_name").alias("a"), F.upper(F.concat("first_name", "email")).alias("b"),
        (F.col("age") + 1).alias("c"), F.lit(1).alias("d"), F.explode(F.split("email", "@")).alias("e"),
        F.col("email").alias("f", metadata={"data_class": "internal"}),
    )
    assert kinds(made) == {"a": "pii", "b": "sensitive_pii", "c": "public", "d": "public", "e": "sensitive_pii", "f": "internal"}
    from pyspark.sql import Window

    ranked = users.withColumn("r", F.rank().over(Window.partitionBy("country").orderBy("first_name")))
    assert kinds(ranked)["r"] == "pii"
    joined = users.join(costs, users["user_id"] == costs["product_id"])
    grouped = joined.groupBy("country").agg(F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("n"), F.max("email").alias("m"))
    assert kinds(grouped) == {"country": "public", "cost": "internal", "n": "public", "m": "sensitive_pii"}
    both = users.select(F.col("country").alias("v")).union(users.select("first_name"))
    assert kinds(both) == {"v": "pii"}
    assert kinds(users.crossJoin(plain.select(F.col("age").alias("unknown"))).select((F.col("unknown") + 1).alias("u"), "age")) == {"u": None, "age": "public"}
    assert kinds(users.mapInPandas(lambda rows: rows, ddl))["country"] == "sensitive_pii"
    shown = contracts.visible_to(contracts.inherit(made), {"public"})
    assert shown.columns == ["c", "d"]
