from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from support import plan
from pyspark.sql import functions as F

from martweave.functions import business, calendar, money
from martweave.functions.audit import Run
from martweave.functions.privacy import SaltMissing, pseudonymise, salt_column, salt_from_env


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_known_hash(spark):
    expected = "f4bf9f7fcbedaba0392f108c59d8f4a38b3838efb64877380171b54475c2ade8"
    assert one(spark, pseudonymise(F.lit("a"), salt_column(spark, "s"))) == expected


def test_missing_value_is_not_hashed(spark):
    value = F.lit(None).cast("string")
    assert one(spark, pseudonymise(value, salt_column(spark, "s"))) is None


def test_salt_stays_out_of_the_plan(spark):
    salt = "do-not-show-this"
    people = spark.createDataFrame([("a",), (None,)], "email string")
    hashed = people.select(pseudonymise("email", salt_column(spark, salt)).alias("email"))
    assert salt not in plan(hashed)
    hashed.collect()
    assert salt not in plan(hashed)


def test_salt_must_be_set(spark, monkeypatch):
    monkeypatch.delenv("PSEUDONYMISATION_SALT", raising=False)
    with pytest.raises(SaltMissing):
        salt_from_env()
    monkeypatch.setenv("PSEUDONYMISATION_SALT", "x")
    assert salt_from_env() == "x"
    with pytest.raises(SaltMissing):
        salt_column(spark, "")


@pytest.mark.parametrize(
    "status, price, net",
    [("Returned", 100.0, 0.0), (None, 100.0, 100.0), ("Cancelled", 100.0, 100.0), ("Complete", None, None)],
)
def test_net_revenue(spark, status, price, net):
    column = business.net_revenue(F.lit(status).cast("string"), F.lit(price).cast("double"))
    assert one(spark, column) == net


def test_missing_status_is_not_returned(spark):
    assert one(spark, business.is_returned(F.lit(None).cast("string"))) is False


@pytest.mark.parametrize(
    "start, end, days",
    [
        ("2024-03-01 23:00:00", "2024-03-02 01:00:00", 1),
        ("2024-03-01 00:00:00", "2024-03-01 23:59:59", 0),
        ("2024-03-02 01:00:00", "2024-03-01 23:00:00", -1),
        ("2024-03-01 00:00:00", None, None),
    ],
)
def test_days_count_midnights(spark, start, end, days):
    stamps = (F.lit(x).cast("timestamp") for x in (start, end))
    assert one(spark, business.days_between(*stamps)) == days


@pytest.mark.parametrize(
    "items, returned, fully, partly", [(2, 2, True, False), (2, 1, False, True), (2, 0, False, False)]
)
def test_return_flags(spark, items, returned, fully, partly):
    counts = F.lit(items), F.lit(returned)
    assert one(spark, business.is_fully_returned(*counts)) is fully
    assert one(spark, business.is_partially_returned(*counts)) is partly


def test_rate_of_nothing_is_null(spark):
    assert one(spark, money.rate(F.lit(1.0), F.lit(0.0))) is None


def test_exact_sum_does_not_depend_on_order(spark):
    amounts = [0.1, 1e9, -0.3, 1e9 + 0.2, -2e9, 0.7] * 50
    results = set()
    for rows in (amounts, sorted(amounts), amounts[::-1]):
        df = spark.createDataFrame([(a,) for a in rows], "a double").repartition(7)
        results.add(df.agg(money.exact_sum("a")).first()[0])
    assert results == {35.0}


def test_exact_sum_skips_nulls_and_is_null_of_none(spark):
    df = spark.createDataFrame([(1, 1.25), (1, None), (2, None)], "k int, a double")
    got = df.groupBy("k").agg(
        money.exact_sum("a").alias("s"), money.exact_avg("a").alias("m"), money.exact_sum("a", units=None).alias("f")
    )
    assert {tuple(r) for r in got.collect()} == {(1, 1.25, 1.25, 1.25), (2, None, None, None)}


def test_exact_sum_beyond_one_integer(spark):
    """The plain integer sum of these would overflow."""
    df = spark.range(40).select(F.lit(5e13).alias("a"))
    assert df.agg(money.exact_sum("a")).first()[0] == 2e15


def test_sunday_and_leap_day(spark):
    sunday, leap = F.lit(date(2024, 1, 7)), F.lit(date(2024, 12, 31))
    assert one(spark, calendar.day_of_week(sunday)) == 0
    assert one(spark, calendar.is_weekend(sunday)) is True
    assert one(spark, calendar.year_month(sunday)) == "2024-01"
    assert one(spark, calendar.year_quarter(sunday)) == "2024-Q1"
    assert one(spark, F.dayofyear(leap)) == 366
    assert one(spark, calendar.is_weekend(F.lit(date(2024, 1, 8)))) is False


def test_moment_is_utc_whatever_the_zone_given(spark):
    from datetime import timedelta

    east = datetime(2024, 1, 1, 2, tzinfo=timezone(timedelta(hours=2)))
    assert one(spark, calendar.moment(east).cast("string")) == "2024-01-01 00:00:00"
    assert one(spark, calendar.moment(date(2024, 1, 1)).cast("string")) == "2024-01-01 00:00:00"


def test_one_run_one_stamp(spark):
    run = Run()
    stamped = run.stamp(spark.range(100).repartition(5))
    assert stamped.select("_loaded_at", "_run_id").distinct().count() == 1
    again = Run("second", datetime(2024, 1, 1, tzinfo=timezone.utc)).stamp(stamped)
    assert again.select("_run_id").distinct().first()[0] == "second"
    assert again.columns == stamped.columns


def test_units_and_odd_amounts(spark):
    tiny = spark.range(1000).select(F.lit(0.00004).alias("a"))
    assert tiny.agg(money.exact_sum("a")).first()[0] == 0.0
    assert tiny.agg(money.exact_sum("a", units=1e6)).first()[0] == 0.04
    assert abs(tiny.agg(money.exact_sum("a", units=None)).first()[0] - 0.04) < 1e-12
    odd = spark.createDataFrame([(1, 1.5), (1, float("nan")), (2, 2.5), (2, float("inf")), (3, 1e300), (4, None)], "k int, a double")
    got = dict(odd.groupBy("k").agg(money.exact_sum("a")).collect())
    assert got[1] != got[1] and got[2] == float("inf") and got[3] == 1e300 and got[4] is None
