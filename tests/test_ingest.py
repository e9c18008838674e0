from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from support import plan, values
from pyspark.sql import functions as F

from martweave.operators import ingest
from martweave.plans.ingest_run import Freshness, has_failed, landed, run_ingest
from martweave.sources.landed import LandedTable
from martweave.sources.landing import BACKFILL_START, LANDINGS, Landing, Registry
from martweave.sources.tpch import LANDED
from martweave.streaming.ingest import file_stream, stream_into

UTC = timezone.utc
DDL = "id bigint, v string, at timestamp"


def at(day, month=1, hour=0, year=2024):
    return datetime(year, month, day, hour)


def rows(spark, *data):
    return spark.createDataFrame(list(data), DDL)


def test_a_cursor_may_lie_outside_the_layout(spark, tmp_path):
    t = LandedTable(spark, str(tmp_path / "plain"), DDL, ["id"])
    t.merge(rows(spark, (1, "a", at(1)), (2, "b", at(2))), "one", "at")
    t.merge(rows(spark, (2, "c", at(3))), "two", "at")
    assert values(t.read(), "id", "v") == [(1, "a"), (2, "c")] and t.last_value() is None


def table(spark, tmp_path, name="t", **kw):
    return LandedTable(spark, str(tmp_path / name), DDL, ["id"], month_of="at", **kw)


def test_cutoff_is_inclusive_and_pushed(spark, tmp_path):
    path = str(tmp_path / "p")
    rows(spark, (1, "a", at(1)), (2, "b", at(2)), (3, "c", at(3))).write.parquet(path)
    stored = spark.read.schema(DDL).parquet(path)
    got = ingest.since(stored, datetime(2024, 1, 2, tzinfo=UTC), "at")
    assert values(got, "id") == [(2,), (3,)]
    assert "GreaterThanOrEqual(at," in plan(got)
    back = ingest.since(stored, datetime(2024, 1, 2, tzinfo=UTC), "at", timedelta(days=1))
    assert back.count() == 3


def test_the_bound_may_be_a_parameter_of_fixed_text(spark, tmp_path):
    path = str(tmp_path / "p")
    rows(spark, (1, "a", at(1)), (2, "b", at(2)), (3, "c", at(3))).write.parquet(path)
    stored = spark.read.schema(DDL).parquet(path)
    got = ingest.since_by_marker(stored, datetime(2024, 1, 2, tzinfo=UTC), "at")
    assert values(got, "id") == [(2,), (3,)] and got.columns == stored.columns
    assert "GreaterThanOrEqual(at,2024-01-02" in plan(got)


def test_watermark(spark):
    assert ingest.high_watermark(rows(spark, (1, "a", at(1)), (2, "b", at(9))), "at").first()[0] == at(9)
    assert ingest.high_watermark(rows(spark), "at").first()[0] is None


def test_latest_per_key_breaks_ties_the_same_way(spark):
    batch = rows(spark, (1, "a", at(1)), (1, "b", at(1)), (1, None, at(1)), (2, "x", at(1)), (2, "w", at(2)))
    for parts in (1, 3, 7):
        got = ingest.latest_per_key(batch.repartition(parts), ["id"], ["at"])
        assert values(got, "id", "v") == [(1, "b"), (2, "w")]


def test_copies_are_dropped_before_the_shuffle(spark):
    batch = spark.range(1000).select((F.col("id") % 2).alias("id"), F.col("id").alias("v"))
    text = plan(ingest.latest_per_key(batch, ["id"], ["v"]))
    physical = text[text.index("== Physical Plan ==") :]
    assert "Partial" in physical[physical.index("Exchange") :]


def split_pick(batch, keys, newest_first):
    copied = batch.groupBy(*keys).count().filter("count > 1")
    return ingest.one_per_key(batch, copied, keys, newest_first)


@pytest.mark.parametrize("pick", [ingest.latest_per_key, split_pick])
def test_upsert(spark, pick):
    target = rows(spark, (1, "old", at(1)), (2, "old", at(2)), (None, "kept", at(3)))
    batch = rows(spark, (2, "new", at(2)), (2, "newer", at(3)), (3, "new", at(3)))
    latest = pick(batch, ["id"], ["at"])
    once = ingest.upsert(target, latest, ["id"])
    assert values(once, "id", "v") == [(1, "old"), (2, "newer"), (3, "new"), (None, "kept")]
    twice = ingest.upsert(once, latest, ["id"], arriving=batch)
    assert values(twice, "id", "v") == values(once, "id", "v")


def test_ranking_copied_keys_apart_gives_the_same(spark):
    batch = spark.range(3000).select(
        F.expr("if(id % 3 = 0, 5, id % 1500)").alias("id"), (F.col("id") % 7).alias("v"), F.col("id").alias("at")
    )
    one = split_pick(batch, ["id"], ["at"])
    assert values(one, "*") == values(ingest.latest_per_key(batch, ["id"], ["at"]), "*")


def test_new_row_wins_even_if_older_or_null(spark):
    got = ingest.upsert(rows(spark, (1, "old", at(9))), rows(spark, (1, None, at(1))), ["id"])
    assert values(got, "id", "v") == [(1, None)]


def test_load_volume_and_audit(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "_load_id string")
    assert values(ingest.load_volume(df, "t"), "load_id", "rows", "rows_before", "change") == [
        ("a", 1, None, None),
        ("b", 2, 1, 1),
        ("c", 1, 2, -1),
    ]
    assert tuple(ingest.load_audit(df, "t").first()) == ("t", 4, "a", "c")


def test_load_monitor(spark):
    brought = [100, 104, 96, 101, 99, 103, 300, 98, 30, 100, 140]
    df = spark.createDataFrame([(f"s-{k}", n) for k, n in enumerate(brought)], "load_id string, rows int")
    rule = ingest.VolumeRule(loads=6, least=3, spread=5.0, share=0.3)
    got = {int(r.load_id[2:]): r for r in ingest.load_monitor(df, "t", rule).collect()}
    assert [got[k].status for k in range(11)] == ["new"] * 3 + ["normal"] * 3 + ["abnormal", "normal", "abnormal", "normal", "abnormal"]
    assert (got[6].usual_rows, got[6].deviation) == (100.5, 2.0) and got[0].usual_rows is None
    assert ingest.load_monitor(df.limit(0), "t").count() == 0


def test_an_abnormal_load_is_reported_or_refused(spark, tmp_path):
    landing = Landing("s", "t", DDL, ("id",), "at", True)
    sizes = iter([5, 5, 6, 40, 40, 40])

    def read(source, name, start):
        n = next(sizes)
        first = int((start - datetime(2024, 1, 1, tzinfo=UTC)).days) + 1
        return spark.range(n).select((F.col("id") + 1000 * first).alias("id"), F.lit("x").alias("v"), F.lit(at(first + 1)).alias("at"))

    run = lambda load_id, rule, **kw: run_ingest(
        spark, read, str(tmp_path), load_id, datetime(2024, 1, 1, tzinfo=UTC), landings={"t": landing}, volume=rule, **kw
    ).first()
    rule = ingest.VolumeRule(least=3)
    assert [run(f"l-{k}", rule).volume for k in range(3)] == ["new"] * 3
    t = landed(spark, str(tmp_path), landing)
    refused = run("l-3", ingest.VolumeRule(least=3, fail=True))
    assert (refused.status, refused.volume) == ("failed", "abnormal") and "40 rows" in refused.error
    assert t.read().count() == 16 and t.loads().count() == 3
    fresh = Freshness(datetime(2024, 1, 7, tzinfo=UTC), timedelta(days=1), timedelta(days=3))
    taken = run("l-3", rule, fresh=fresh)
    assert (taken.status, taken.volume, taken.freshness) == ("loaded", "abnormal", "warn") and t.read().count() == 56
    assert run("l-4", None).volume is None


@pytest.mark.parametrize("hours, status", [(1, "pass"), (30, "warn"), (100, "error"), (None, "error")])
def test_freshness(spark, hours, status):
    now = datetime(2024, 1, 10, tzinfo=UTC)
    df = rows(spark, *([] if hours is None else [(1, "a", at(10) - timedelta(hours=hours))]))
    got = ingest.freshness(df, "t", "at", now, timedelta(hours=24), timedelta(hours=72)).first()
    assert (got.age_hours, got.status) == (hours, status)


# --- the stored table -----------------------------------------------------


def months(t):
    return set(r[0] for r in t.by_month().select("partition_month").distinct().collect())


def test_empty_table(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.is_new() and t.last_value() is None and t.read().count() == 0 and t.loads().count() == 0


def test_merge_again_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    batch = rows(spark, (1, "a", at(1)), (2, "b", at(1, 2)))
    first = t.merge(batch, "one", "at")
    assert t.merge(rows(spark, (9, "z", at(1))), "one", "at") == first  # same load: skipped
    t.merge(batch, "two", "at")  # same rows, another load
    assert values(t.read(), "id", "v", "_load_id") == [(1, "a", "two"), (2, "b", "two")]
    assert t.last_value() == first.last_value == datetime(2024, 2, 1, tzinfo=UTC)
    assert values(t.loads(), "load_id", "rows") == [("one", 2), ("two", 2)]


def test_cursor_boundary_row_is_read_again_once(spark, tmp_path):
    t = table(spark, tmp_path)
    source = [(1, "a", at(1)), (2, "b", at(5))]
    t.merge(rows(spark, *source), "one", "at")
    source[1] = (2, "changed", at(5))
    source.append((3, "c", at(7)))
    t.merge(ingest.since(rows(spark, *source), t.last_value(), "at"), "two", "at")
    assert values(t.read(), "id", "v") == [(1, "a"), (2, "changed"), (3, "c")]


def test_a_load_rewrites_only_its_months(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(rows(spark, (1, "a", at(1, 1)), (2, "b", at(1, 2)), (3, "c", at(1, 3)), (9, "k", at(2, 3))), "one", "at")
    files = lambda: {m: sorted(f.name for f in (tmp_path / "t" / "rows" / f"partition_month=2024-0{m}").glob("*.parquet")) for m in (1, 2, 3)}
    before = files()
    t.merge(rows(spark, (3, "d", at(2, 3))), "two", "at")
    assert values(t.read(), "id", "v") == [(1, "a"), (2, "b"), (3, "d"), (9, "k")]
    after = files()
    assert {m for m in before if before[m] != after[m]} == {3}


def test_key_that_moves_to_another_month_stays_single(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(rows(spark, (1, "a", at(1, 1)), (2, "b", at(1, 2)), (5, "e", at(1, 3))), "one", "at")
    t.merge(rows(spark, (1, "moved", at(9, 3))), "two", "at")
    assert values(t.read(), "id", "v", "at") == [
        (1, "moved", at(9, 3)),
        (2, "b", at(1, 2)),
        (5, "e", at(1, 3)),
    ]
    assert months(t) == {"2024-02", "2024-03"}  # January is empty now


@pytest.mark.parametrize("small", ["-1", "10MB"])
def test_many_loads_equal_one_table_of_latest_rows(spark, tmp_path, conf, small):
    """Against brute force: each key's row of the last load that brought it."""
    import random

    conf(spark__sql__autoBroadcastJoinThreshold=small)
    draw = random.Random(7)
    t, expected = table(spark, tmp_path), {}
    for n in range(5):
        batch = {}
        for _ in range(60):
            key = draw.randrange(80)
            batch[key] = (key, f"{n}-{draw.randrange(9)}", at(draw.randrange(1, 28), draw.randrange(1, 5)))
        t.merge(rows(spark, *batch.values()), f"load-{n}", "at")
        expected.update(batch)
    assert values(t.read(), "id", "v", "at") == sorted(expected.values(), key=repr)
    assert len(t.read().inputFiles()) == len(months(t))  # a month's rows lie together
    assert t.last_value() is not None


def test_a_large_month_is_split_into_files(spark, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    t = table(spark, tmp_path)
    big = spark.range(0, 200_000, 1, 8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(at(1)).alias("at")
    )
    t.merge(big, "one", "at")
    assert len(t.read().inputFiles()) > 4
    assert t.read().count() == 200_000


def test_rows_are_staged_and_put_in_force_without_a_shuffle(spark, tmp_path, monkeypatch, conf):
    """By several tasks; still a month's rows lie together."""
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="256KB")
    written = []
    write = LandedTable._write

    def seen(self, df, place, *how):
        written.append((plan(df), df.select(F.spark_partition_id()).distinct().count()))
        write(self, df, place, *how)

    monkeypatch.setattr(LandedTable, "_write", seen)
    t = table(spark, tmp_path)
    days = spark.range(0, 4000, 1, 8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 7200).alias("at")
    )
    t.merge(days, "one", "at")
    assert len(written) == 2 and not any("Exchange" in text for text, _ in written)
    assert 1 < written[1][1] <= len(months(t)) == len(t.read().inputFiles())
    assert values(t.read(), "id", "v", "at") == values(days, "id", "v", "at")
    assert t.read().inputFiles()[0].endswith(".zstd.parquet")


def test_keys_that_look_alike_by_their_hash_stay_apart(spark, tmp_path, monkeypatch):
    t = LandedTable(spark, str(tmp_path / "k"), DDL, ["id", "at"], month_of="at")
    monkeypatch.setattr(F, "xxhash64", lambda *_: F.lit(7).cast("bigint"))
    t.merge(rows(spark, (1, "a", at(1)), (1, "b", at(2)), (2, "c", at(2)), (2, "d", at(2))), "one", "at")
    assert values(t.read(), "v") == [("a",), ("b",), ("d",)]


def test_empty_batch_keeps_rows_and_cursor(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(rows(spark, (1, "a", at(1))), "one", "at")
    t.merge(rows(spark), "two", "at")
    assert t.read().count() == 1
    assert t.last_value() == datetime(2024, 1, 1, tzinfo=UTC)
    assert t.has("two") and not t.has("three")


@pytest.mark.parametrize("again", ["two", "three"])
def test_a_load_that_dies_before_it_is_staged_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch, again):
    t = table(spark, tmp_path)
    t.merge(rows(spark, (1, "a", at(1))), "one", "at")

    def die(*_):
        raise OSError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(LandedTable, "_enter", die)
        with pytest.raises(OSError):
            t.merge(rows(spark, (1, "b", at(1)), (2, "c", at(2))), "two", "at")
    assert values(t.read(), "id", "v") == [(1, "a")] and not t.has("two")
    assert t.last_value() == datetime(2024, 1, 1, tzinfo=UTC)
    t.merge(rows(spark, (1, "d", at(1)), (2, "c", at(2))), again, "at")
    assert values(t.read(), "id", "v") == [(1, "d"), (2, "c")]


@pytest.mark.parametrize("lost", [True, False])
@pytest.mark.parametrize("again", ["two", "three"])
def test_a_load_that_dies_while_months_are_replaced_is_finished(spark, tmp_path, monkeypatch, lost, again):
    """Whichever load comes next; even where Spark had deleted a month and not yet moved the new one."""
    import shutil

    t = table(spark, tmp_path)
    t.merge(rows(spark, (1, "a", at(1)), (2, "b", at(1, 2)), (3, "c", at(1, 3)), (4, "d", at(2, 3))), "one", "at")

    def die(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(LandedTable, "_put_in_force", die)
        with pytest.raises(OSError):
            t.merge(rows(spark, (1, "moved", at(1, 3)), (5, "e", at(1, 2))), "two", "at")
    if lost:
        for month in ("02", "03"):
            shutil.rmtree(tmp_path / "t" / "rows" / f"partition_month=2024-{month}")
    t.merge(rows(spark, (6, "f", at(1, 4))), again, "at")
    want = [(1, "moved"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]
    assert values(t.read(), "id", "v") == (want if again == "two" else [*want, (6, "f")])
    assert months(t) == {"2024-02", "2024-03"} | ({"2024-04"} if again == "three" else set())
    assert t.has("two") and list((tmp_path / "t" / "staging").iterdir()) == []


def test_nothing_of_a_load_stays_beside_its_rows(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(rows(spark, (1, "a", at(1)), (1, "b", at(2))), "one", "at")
    t.merge(rows(spark, (1, "c", at(3))), "two", "at")
    assert list((tmp_path / "t" / "staging").iterdir()) == []


def test_ids_of_loads_may_hold_any_sign(spark, tmp_path):
    t = table(spark, tmp_path)
    for load_id in ("2024-01-01 10:00", "a=b/c%d", "7"):
        t.merge(rows(spark, (1, load_id, at(1))), load_id, "at")
    t.merge(rows(spark, (1, "again", at(1))), "a=b/c%d", "at")
    assert values(t.read(), "v") == [("7",)] and t.loads().count() == 3


@pytest.mark.parametrize("fixed", [True, False])
def test_only_months_that_are_touched_are_staged(spark, tmp_path, monkeypatch, fixed):
    t = table(spark, tmp_path)
    t.merge(rows(spark, *((m, "a", at(10, m)) for m in range(1, 7))), "one", "at")
    touched = []
    enter = LandedTable._enter
    monkeypatch.setattr(LandedTable, "_enter", lambda self, load, part, found: touched.append(sorted(found)) or enter(self, load, part, found))
    t.merge(rows(spark, (3, "b", at(11, 3)), (9, "c", at(1, 5)), (6, "d", at(1, 5))), "two", "at", month_is_fixed=fixed)
    assert [m[-2:] for m in touched[0]] == (["03", "05"] if fixed else ["03", "05", "06"])
    assert (3, "b") in values(t.read(), "id", "v")


def test_several_columns_may_be_the_key(spark, tmp_path):
    t = LandedTable(spark, str(tmp_path / "k"), DDL, ["id", "at"], month_of="at")
    t.merge(rows(spark, (1, "a", at(1)), (1, "b", at(2)), (1, "c", at(2))), "one", "at")
    t.merge(rows(spark, (1, "d", at(2)), (1, "e", at(3))), "two", "at")
    assert values(t.read(), "v") == [("a",), ("d",), ("e",)]


def test_read_between_lists_only_its_months(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(rows(spark, *((m, "a", at(10, m)) for m in range(1, 7))), "one", "at")
    got = t.read(datetime(2024, 2, 10, tzinfo=UTC), datetime(2024, 4, 10, tzinfo=UTC))
    assert values(got, "id") == [(2,), (3,)]
    assert "(partition_month" in plan(got) and "PartitionFilters: []" not in plan(got)


def test_replace_drops_what_was_there(spark, tmp_path):
    t = LandedTable(spark, str(tmp_path / "r"), DDL, ["id"])
    t.replace(rows(spark, (1, "a", at(1)), (2, "b", at(1))), "one")
    assert t.replace(rows(spark, (3, "c", at(1))), "two").rows == 1
    assert values(t.read(), "id", "_load_id") == [(3, "two")]
    t.replace(rows(spark), "three")
    assert t.read().count() == 0


def test_undeclared_columns_are_refused(spark, tmp_path):
    t = table(spark, tmp_path)
    with pytest.raises(ValueError):
        t.merge(rows(spark, (1, "a", at(1))).withColumn("more", F.lit(1)), "one", "at")
    with pytest.raises(ValueError):
        t.merge(rows(spark, (1, "a", at(1))).drop("v"), "one", "at")
    with pytest.raises(ValueError):
        t.merge(rows(spark, (1, "a", at(1))).withColumn("id", F.lit("1")), "one", "at")


def test_rows_without_a_key_are_refused(spark, tmp_path):
    t = table(spark, tmp_path)
    with pytest.raises(ValueError, match="without a key"):
        t.merge(rows(spark, (None, "a", at(1)), (1, "b", at(1))), "one", "at")
    assert t.is_new()


@pytest.mark.parametrize("small", ["-1", "10MB"])
def test_copies_in_a_batch_land_once(spark, tmp_path, conf, small):
    conf(spark__sql__autoBroadcastJoinThreshold=small)
    t = table(spark, tmp_path)
    t.merge(rows(spark, (1, "a", at(1)), (1, "b", at(2)), (1, "c", at(1)), (2, "d", at(1))), "one", "at")
    assert values(t.read(), "id", "v") == [(1, "b"), (2, "d")]


def test_rows_without_a_date_are_kept(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(rows(spark, (1, "a", None), (2, "b", at(1))), "one", "at")
    t.merge(rows(spark, (1, "c", None)), "two", "at")
    assert values(t.read(), "id", "v") == [(1, "c"), (2, "b")]


# --- whole runs -----------------------------------------------------------


def test_run_ingest_twice_and_with_a_failure(spark, folder, tmp_path):
    import __spark_entry__ as entry

    tables = entry.OrderTables(spark, folder)
    root = str(tmp_path / "raw")
    first = run_ingest(spark, tables.read, root, "one", entry.FIRST_LOAD)
    assert not has_failed(first)

    def broken(source, name, start):
        if name == "products":
            raise RuntimeError("source is down")
        return tables.read(source, name, start)

    second = run_ingest(spark, broken, root, "two", entry.FIRST_LOAD)
    assert has_failed(second)
    assert values(second.filter("status = 'failed'"), "table", "error") == [("products", "source is down")]
    # Only the boundary rows came again, and nothing is in twice.
    by_table = {r.table: r.rows for r in second.collect()}
    assert by_table["orders"] < 20 and by_table["order_items"] < 20
    orders = landed(spark, root, LANDINGS["orders"])
    assert orders.read().count() == orders.read().select("order_id").distinct().count()
    expected = ingest.since(tables.orders(["created_at"]), entry.FIRST_LOAD).count()
    assert orders.read().count() == expected
    assert landed(spark, root, LANDINGS["products"]).read().count() == tables.products().count()


def test_every_line_lands(spark, folder, tmp_path):
    import __spark_entry__ as entry

    tables, root = entry.OrderTables(spark, folder), str(tmp_path / "raw")
    run_ingest(spark, tables.read, root, "one", entry.ALL_HISTORY, landings=LANDED)
    stored = landed(spark, root, LANDED["order_items"]).read()
    assert stored.count() == tables.table("lineitem").count() == 6000
    assert stored.select("id").distinct().count() == 5999  # two lines share an id and both stay


def test_the_cursor_bound_reaches_the_scan_of_a_run(spark, folder, tmp_path):
    import __spark_entry__ as entry

    tables, read = entry.OrderTables(spark, folder), {}

    def seen(source, name, start):
        read[name] = tables.read(source, name, start)
        return read[name]

    run_ingest(spark, seen, str(tmp_path / "raw"), "one", entry.FIRST_LOAD, landings=LANDED)
    assert "GreaterThanOrEqual(l_shipdate," in plan(read["order_items"])
    assert "GreaterThanOrEqual(o_orderdate," in plan(read["orders"])


def test_loads_are_ordered_by_their_numbers(spark):
    ids = [f"s-{n}" for n in range(12)] + ["s-100"]
    df = spark.createDataFrame([(i,) for k, i in enumerate(ids) for _ in range(k + 1)], "_load_id string")
    got = {r.load_id: r.change for r in ingest.load_volume(df, "t").collect()}
    assert got == {i: 1 if k else None for k, i in enumerate(ids)}
    assert tuple(ingest.load_audit(df, "t").first()) == ("t", 91, "s-0", "s-100")
    dates = spark.createDataFrame([("2024-02-01",), ("2023-12-31",), ("2024-01-09",)], "_load_id string")
    assert ingest.load_audit(dates, "t").first().first_load_id == "2023-12-31"


def test_backfill_starts_before_the_horizon():
    from martweave.operators.staging import HORIZON

    assert BACKFILL_START.date() < HORIZON


def test_registry(spark, folder, tmp_path):
    import __spark_entry__ as entry

    place = str(tmp_path / "products")
    entry.OrderTables(spark, folder).products().write.parquet(place)
    registry = Registry(spark, {("catalogue", "products"): place})
    assert registry.read("catalogue", "products").columns == LANDINGS["products"].columns
    with pytest.raises(KeyError):
        registry.read("shop", "products")
    with pytest.raises(KeyError):
        registry.read("crm", "users")


def test_a_stream_reads_a_file_and_a_folder_alike(spark, tmp_path):
    batch = rows(spark, (1, "a", at(1)), (2, "b", at(2)), (3, "c", at(3)))
    batch.repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    batch.coalesce(1).write.parquet(str(tmp_path / "one"))
    next((tmp_path / "one").glob("part-*")).rename(tmp_path / "single.parquet")
    for name in ("many.parquet", "single.parquet"):
        t = table(spark, tmp_path, f"of-{name}")
        stream = file_stream(spark, str(tmp_path / name), DDL, maxFilesPerTrigger="1")
        stream_into(stream, t, str(tmp_path / f"ck-{name}"), "at", "s").awaitTermination()
        assert values(t.read(), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]
    assert table(spark, tmp_path, "of-many.parquet").loads().count() > 1  # several bounded batches
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        file_stream(spark, str(tmp_path / "none"), DDL)


def test_stream_is_replayed_without_doubles(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    t = table(spark, tmp_path, "streamed")

    def run():
        stream = file_stream(spark, source, DDL)
        first = datetime(2024, 1, 2, tzinfo=UTC)
        stream_into(stream, t, checkpoint, "at", "s", first).awaitTermination()

    rows(spark, (1, "early", at(1)), (2, "a", at(2)), (3, "b", at(3))).write.parquet(source)
    run()
    assert values(t.read(), "id", "v") == [(2, "a"), (3, "b")]
    rows(spark, (3, "late", at(3)), (4, "c", at(2))).write.mode("append").parquet(source)
    run()
    run()  # nothing new
    assert values(t.read(), "id", "v", "_load_id") == [(2, "a", "s-0"), (3, "late", "s-1"), (4, "c", "s-1")]
    # A batch handed over again after a crash is recognised by its id.
    t.merge(rows(spark, (4, "again", at(2))), "s-1", "at")
    assert values(t.read(), "id", "v") == [(2, "a"), (3, "late"), (4, "c")]
