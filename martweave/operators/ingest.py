"""Incremental ingest as DataFrames: cursor scan, upsert, load accounting."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martweave.functions.calendar import moment, moment_text

LOAD_ID = "_load_id"


def since(
    df: DataFrame, cutoff: datetime, cursor: str = "created_at", lookback: timedelta | None = None
) -> DataFrame:
    """Rows from the cutoff on, the boundary included.

    The bound is a typed literal, so it reaches the parquet scan. A row changed
    after it was loaded lies behind the cursor and is missed, unless ``lookback``
    re-reads a trailing span.
    """
    start = cutoff - lookback if lookback else cutoff
    return df.filter(F.col(cursor) >= moment(start).cast(df.schema[cursor].dataType))


def since_by_marker(df: DataFrame, cutoff: datetime, cursor: str = "created_at") -> DataFrame:
    """:func:`since` as SQL text that never changes: the bound is a parameter, not part of the text.

    A cutoff from outside can so not become SQL, and reaches the scan as a typed literal.
    """
    kind = df.schema[cursor].dataType.simpleString()
    return df.sparkSession.sql(
        "SELECT * FROM {rows} WHERE {cursor} >= CAST(CAST(:start AS TIMESTAMP) AS " + kind + ")",
        args={"start": moment_text(cutoff)},
        rows=df,
        cursor=F.col(cursor),
    )


def high_watermark(df: DataFrame, cursor: str = "created_at") -> DataFrame:
    """One row: the highest cursor value, NULL where nothing was loaded."""
    return df.agg(F.max(cursor).alias("last_value"))


def stamp_load(df: DataFrame, load_id: str | Column) -> DataFrame:
    return df.withColumn(LOAD_ID, F.lit(load_id) if isinstance(load_id, str) else load_id)


def latest_per_key(batch: DataFrame, keys: list[str], newest_first: list[str]) -> DataFrame:
    """One row per key: the highest by ``newest_first``, then by all other columns.

    Every column takes part in the order, so the winner never depends on where a
    row was read. Keeping the first row is done in each task before the shuffle
    as well, so a key with a great many copies moves one row per task.
    """
    rest = [c for c in batch.columns if c not in keys and c not in newest_first]
    order = [F.col(c).desc_nulls_last() for c in [*newest_first, *rest]]
    if not order:
        return batch.dropDuplicates(keys)
    ranked = batch.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter("_rank = 1").drop("_rank")


def one_per_key(
    batch: DataFrame, copied: DataFrame, keys: list[str], newest_first: list[str]
) -> DataFrame:
    """As :func:`latest_per_key`, given the keys that have copies at all.

    Where the planner finds ``copied`` small enough to broadcast, the rows of all
    other keys are not shuffled. Keys must not be NULL.
    """
    single = batch.join(copied.select(*keys), keys, "left_anti")
    several = batch.join(copied.select(*keys), keys, "left_semi")
    return single.unionByName(latest_per_key(several, keys, newest_first))


def upsert(
    target: DataFrame, rows: DataFrame, keys: list[str], arriving: DataFrame | None = None
) -> DataFrame:
    """``target`` with ``rows`` put in, which hold one row per key; the new row wins.

    Doing it twice gives the same table. ``arriving`` may name the same keys more
    cheaply than ``rows``, say straight from a scan; they decide which target rows
    go. Few keys are broadcast and the target stays where it is; otherwise both
    are hashed by key. A NULL key matches nothing in the target.
    """
    going = (rows if arriving is None else arriving).select(*keys)
    return target.join(going, keys, "left_anti").unionByName(rows)


def load_order(load_id: Column | str) -> Column:
    """Puts loads in order by their ids: numbers in an id count as numbers.

    ``s-10`` comes after ``s-2``, and dates and times as they are. Each run of digits
    is put after its length, both as text of fixed width.
    """
    text = F.col(load_id) if isinstance(load_id, str) else load_id
    parts = F.regexp_extract_all(text, F.lit(r"(\d+|\D+)"), F.lit(1))
    number = F.regexp_replace
    padded = F.transform(
        parts,
        lambda x: F.when(
            x.rlike(r"^\d"),
            F.concat(F.lpad(F.length(number(x, "^0+", "")).cast("string"), 4, "0"), number(x, "^0+", "")),
        ).otherwise(x),
    )
    return F.struct(F.array_join(padded, "\u0001").alias("order"), text.alias("load_id"))


def load_audit(df: DataFrame, table: str) -> DataFrame:
    """One row: rows of a landed table and its first and last load.

    Loads are counted first, so they are ordered one row per load.
    """
    loads = df.groupBy(LOAD_ID).agg(F.count(F.lit(1)).alias("rows"))
    order = load_order(LOAD_ID)
    return loads.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.min_by(LOAD_ID, order).alias("first_load_id"),
        F.max_by(LOAD_ID, order).alias("last_load_id"),
    ).select(F.lit(table).alias("table"), "rows", "first_load_id", "last_load_id")


def load_volume(df: DataFrame, table: str) -> DataFrame:
    """Rows per load beside those of the load before.

    The window runs over one row per load, after the counting.
    """
    before = F.lag("rows").over(Window.partitionBy("table").orderBy(load_order("load_id")))
    counted = df.groupBy(LOAD_ID).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.lit(table).alias("table"), F.col(LOAD_ID).alias("load_id"), "rows").withColumns(
        {"rows_before": before, "change": F.col("rows") - before}
    )


@dataclass(frozen=True)
class VolumeRule:
    """What a usual load is: near the median of the loads before it.

    A load is abnormal if it is further from the median of up to ``loads`` loads
    before it than ``spread`` times their median deviation (scaled to a standard
    deviation) and than ``share`` of the median, so that loads which never vary may
    vary a little. With fewer than ``least`` loads before it a load is new. With
    ``fail`` an abnormal load is not put in force.
    """

    loads: int = 20
    least: int = 5
    spread: float = 5.0
    share: float = 0.5
    fail: bool = False


_NORMAL = 1.4826  # median deviation of a normal distribution, in standard deviations


def _median(ordered: Column) -> Column:
    n = F.size(ordered)
    middle = F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n > 0, middle / 2.0)


def load_monitor(loads: DataFrame, table: str, rule: VolumeRule = VolumeRule()) -> DataFrame:
    """Each load (load_id, rows) beside the median and deviation of those before it.

    ``status`` is new, normal or abnormal. The window runs over one row per load.
    """
    earlier = (
        Window.partitionBy("table").orderBy(load_order("load_id")).rowsBetween(-rule.loads, Window.currentRow - 1)
    )
    named = loads.select(F.lit(table).alias("table"), "load_id", F.col("rows").cast("bigint").alias("rows"))
    seen = named.withColumn("_before", F.array_sort(F.collect_list("rows").over(earlier)))
    seen = seen.withColumn("usual_rows", _median(F.col("_before")))
    far = F.array_sort(F.transform("_before", lambda x: F.abs(x - F.col("usual_rows"))))
    seen = seen.withColumn("deviation", _median(far))
    limit = F.greatest(rule.spread * _NORMAL * F.col("deviation"), rule.share * F.col("usual_rows"))
    status = (
        F.when(F.size("_before") < rule.least, "new")
        .when(F.abs(F.col("rows") - F.col("usual_rows")) > limit, "abnormal")
        .otherwise("normal")
    )
    return seen.withColumn("status", status).drop("_before")


def load_report(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """One row per table: rows and cursor span; ``tables`` maps name to (rows, cursor)."""
    none = F.lit(None).cast("timestamp")
    reports = []
    for name, (df, cursor) in tables.items():
        span = (F.min(cursor), F.max(cursor)) if cursor else (F.min(none), F.max(none))
        reports.append(
            df.agg(
                F.count(F.lit(1)).alias("rows"),
                span[0].cast("timestamp").alias("first_cursor"),
                span[1].cast("timestamp").alias("last_cursor"),
            ).select(F.lit(name).alias("table"), "rows", "first_cursor", "last_cursor")
        )
    return reduce(DataFrame.unionByName, reports)


def staleness(age: Column, warn_after: timedelta, error_after: timedelta) -> Column:
    """pass, warn or error for an age in seconds; an unknown one is an error."""
    return (
        F.when(age.isNull() | (age > int(error_after.total_seconds())), "error")
        .when(age > int(warn_after.total_seconds()), "warn")
        .otherwise("pass")
    )


def freshness(
    df: DataFrame,
    table: str,
    loaded_at: str,
    now: datetime,
    warn_after: timedelta,
    error_after: timedelta,
) -> DataFrame:
    """One row: age of the newest row in whole hours, and pass, warn or error.

    An empty table is an error: nothing ever arrived.
    """
    age = F.timestamp_diff("SECOND", F.col("newest"), moment(now))
    status = staleness(age, warn_after, error_after)
    return df.agg(F.max(loaded_at).cast("timestamp").alias("newest")).select(
        F.lit(table).alias("table"),
        "newest",
        F.floor(age / 3600).cast("bigint").alias("age_hours"),
        status.alias("status"),
    )
