"""A parquet table laid out by month that can be replaced or merged into.

Layout under ``root``::

    rows/partition_month=<yyyy-MM>/   the rows
    loads/load-<id>/                  one row for each load that is in
    staging/load-<id>/                a load under way, by month too; goes after it is in

A load is staged first: its rows as they came, and for a merge the months it
touches with its rows put in. A task writes a file of its own for each month it has
rows of, so staging moves no row between tasks. Only then are those months replaced,
by Spark's dynamic partition overwrite, whose tasks read whole months or shares of a
large one. A load that dies before leaves the table as it was; one that dies while months
are replaced is finished from its staged rows by the next load, whichever that is, so no row is lost; until then a reader may see some
months as they were. One writer per table at a time. The cursor is the newest value
in the rows themselves, so it cannot part from them.

Where a table format with ``MERGE INTO`` is at hand, use that instead.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martweave.functions.calendar import MONTH, moment
from martweave.operators.ingest import LOAD_ID, one_per_key, stamp_load, upsert
from martweave.operators.quality import repeated_keys
from martweave.session import advisory_size, children, exists, remove, size

_UNDATED = "undated"
_LOADS = "load_id string, rows bigint, last_value timestamp"
_STAGED = f"{_LOADS}, part string, touched array<string>"
_PACKED = 4  # bytes a row takes in a task for each byte of its staged file, a low estimate
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _instant(micros: int | None) -> datetime | None:
    """Exact and in UTC; fetched timestamps would be in the driver's local zone."""
    return None if micros is None else _EPOCH + timedelta(microseconds=micros)


def _month_name(value: date | datetime) -> str:
    if isinstance(value, datetime) and value.tzinfo is not None:
        value = value.astimezone(timezone.utc)
    return f"{value:%Y-%m}"


def _union(parts: list[DataFrame]) -> DataFrame:
    """Joined up by halves: Spark analyses every union anew, so a long chain would cost its square."""
    half = len(parts) // 2
    return parts[0] if not half else _union(parts[:half]).union(_union(parts[half:]))


def _folder(load_id: str) -> str:
    return "load-" + re.sub(r"[^A-Za-z0-9.-]", lambda m: f"~{ord(m[0]):x}~", load_id)


@dataclass(frozen=True)
class Load:
    load_id: str
    rows: int  # that the load brought
    last_value: datetime | None


class LandedTable:
    """``ddl`` are the landed columns; ``month_of`` is the date or timestamp column
    rows are laid out by; no table may have a column named as the layout is. Every row also carries the id of the load it came with,
    unless ``stamped`` is off."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        ddl: str,
        keys: list[str],
        month_of: str | None = None,
        stamped: bool = True,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.ddl = f"{ddl}, {LOAD_ID} string" if stamped else ddl
        self.keys = keys
        self.month_of = month_of
        self.stamped = stamped

    # -- reading ---------------------------------------------------------

    def _parquet(self, schema: str, place: str) -> DataFrame:
        if not exists(self.spark, f"{self.root}/{place.removesuffix('/*')}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{place}")

    def by_month(self) -> DataFrame:
        """Current rows with ``partition_month``: a filter on it, or a join with a filtered
        calendar, decides which months are read."""
        return self._parquet(f"{self.ddl}, {MONTH} string", "rows")

    def read(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """Current rows; with bounds, only months that can hold ``[start, end)`` are read."""
        df = self.by_month()
        if self.month_of is not None and (start or end):
            column = F.col(self.month_of)
            kind = df.schema[self.month_of].dataType
            if start:
                df = df.filter((F.col(MONTH) >= _month_name(start)) & (column >= moment(start).cast(kind)))
            if end:
                df = df.filter((F.col(MONTH) <= _month_name(end)) & (column < moment(end).cast(kind)))
        return df.drop(MONTH)

    def loads(self) -> DataFrame:
        """One row per load: id, rows it brought and the newest cursor value among them."""
        return self._parquet(_LOADS, "loads/*")

    def has(self, load_id: str) -> bool:
        """Whether a load is in."""
        return exists(self.spark, f"{self.root}/loads/{_folder(load_id)}/_SUCCESS")

    def is_new(self) -> bool:
        """Whether nothing was ever loaded."""
        return not children(self.spark, f"{self.root}/loads")

    def last_value(self) -> datetime | None:
        """The newest ``month_of`` value; only the newest month is read."""
        months = [c.partition("=")[2] for c in children(self.spark, f"{self.root}/rows")]
        dated = [m for m in months if m and m != _UNDATED]
        if self.month_of is None or not dated:
            return None
        newest = self.by_month().filter(F.col(MONTH) == max(dated))
        return _instant(newest.agg(F.unix_micros(F.max(self.month_of).cast("timestamp"))).first()[0])

    # -- writing ---------------------------------------------------------

    def _checked(self, df: DataFrame, load_id: str) -> DataFrame:
        """The declared columns in order; anything else than just those is refused."""
        declared = self.spark.createDataFrame([], self.ddl)
        if self.stamped:
            declared, df = declared.drop(LOAD_ID), df.drop(LOAD_ID)
        if sorted(df.dtypes) != sorted(declared.dtypes):
            raise ValueError(f"{self.root}: columns {df.dtypes} are not the declared {declared.dtypes}")
        df = df.select(*declared.columns)
        return stamp_load(df, load_id) if self.stamped else df

    def _month(self, df: DataFrame) -> DataFrame:
        if self.month_of is None:
            return df.withColumn(MONTH, F.lit("all"))
        return df.withColumn(MONTH, F.coalesce(F.date_format(self.month_of, "yyyy-MM"), F.lit(_UNDATED)))

    def _write(self, df: DataFrame, place: str, overwrite: str = "static") -> None:
        """Rows into a folder for each month; in a file by time and key, which packs well and
        keeps row groups narrow in time."""
        order = [MONTH, *([self.month_of] if self.month_of else []), *self.keys]
        writer = self._month(df).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(MONTH)
        writer = writer.option("compression", "zstd").option("partitionOverwriteMode", overwrite)
        writer.parquet(f"{self.root}/{place}")

    def _staged(self, place: str) -> DataFrame:
        return self._parquet(f"{self.ddl}, {MONTH} string", place).drop(MONTH)

    def _months_in(self, place: str) -> list[str]:
        return [c.removeprefix(f"{MONTH}=") for c in children(self.spark, f"{self.root}/{place}")]

    def _gathered(self, place: str) -> DataFrame:
        """Staged rows; a task reads all of some small months or a share of a large one, so a
        month's rows lie together in few files and nothing is shuffled."""
        folders = [f"{self.root}/{place}/{MONTH}={month}" for month in self._months_in(place)]
        sizes = [size(self.spark, folder) for folder in folders]
        limit = max(1, advisory_size(self.spark) // _PACKED)
        share = min(limit, sum(sizes) // self.spark.sparkContext.defaultParallelism)
        parts: list[tuple[list[str], int]] = []
        for folder, found in zip(folders, sizes):
            if parts and parts[-1][1] + found <= share:
                together, held = parts.pop()
                parts.append(([*together, folder], held + found))
            else:
                parts.append(([folder], found))
        read = self.spark.read.schema(self.ddl)
        gathered = [read.parquet(*together).coalesce(-(-held // limit)) for together, held in parts]
        return _union(gathered or [self.spark.createDataFrame([], self.ddl)])

    def _stage(self, df: DataFrame, load_id: str, cursor: str | None) -> tuple[DataFrame, dict]:
        """The rows of a load, written; and what was seen while they were written."""
        place = f"staging/{_folder(load_id)}/batch"
        newest = F.unix_micros(F.max(cursor).cast("timestamp")) if cursor else F.lit(None).cast("bigint")
        seen = Observation()
        observed = self._checked(df, load_id).observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            newest.alias("newest"),
            F.min(self.keys[0]).alias("low"),
            F.max(self.keys[0]).alias("high"),
            F.count_if(reduce(or_, (F.col(k).isNull() for k in self.keys))).alias("keyless"),
        )
        self._write(observed, place)
        return self._staged(place), seen.get

    def _may_have_copies(self, staged: DataFrame) -> bool:
        """Whether a key may come twice. Several key columns are moved as one hash, by which
        different keys may look alike; the exact search for copies then finds none."""
        key = F.col(self.keys[0]) if len(self.keys) == 1 else F.xxhash64(*self.keys)
        return not repeated_keys(staged.select(key.alias("_key")), "_key").isEmpty()

    def _put_in_force(self, folder: str) -> None:
        """Replace the months a staged load touches, enter the load and drop what was staged."""
        staging = f"{self.root}/staging/{folder}"
        load = self.spark.read.schema(_STAGED).parquet(f"{staging}/load")
        head = load.select("part", "touched").first()
        place = f"staging/{folder}/{head.part}"
        self._write(self._gathered(place), "rows", "static" if head.touched is None else "dynamic")
        for month in set(head.touched or ()).difference(self._months_in(place)):
            remove(self.spark, f"{self.root}/rows/{MONTH}={month}")
        entered = load.drop("part", "touched").coalesce(1)
        entered.write.mode("overwrite").parquet(f"{self.root}/loads/{folder}")
        remove(self.spark, staging)

    def _finish(self) -> None:
        """Put in force what an earlier writer staged whole and died over; drop the rest."""
        for folder in children(self.spark, f"{self.root}/staging"):
            if exists(self.spark, f"{self.root}/staging/{folder}/load/_SUCCESS"):
                self._put_in_force(folder)

    def _enter(self, load: Load, part: str, touched: list[str] | None) -> Load:
        folder = _folder(load.load_id)
        row = self.spark.createDataFrame([(load.load_id, load.rows, load.last_value, part, touched)], _STAGED)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/staging/{folder}/load")
        self._put_in_force(folder)
        return load

    def _entered(self, load_id: str) -> Load:
        row = self._parquet(_LOADS, f"loads/{_folder(load_id)}").select("rows", F.unix_micros("last_value")).first()
        return Load(load_id, row[0], _instant(row[1]))

    def replace(
        self, df: DataFrame, load_id: str, check: Callable[[DataFrame, int], None] | None = None
    ) -> Load:
        """Drop the old rows and keep these; a load that is in already is skipped.

        ``check`` sees the rows as staged and their number; if it raises, the old ones stay.
        """
        self._finish()
        if self.has(load_id):
            return self._entered(load_id)
        staged, seen = self._stage(df, load_id, None)
        if check is not None:
            check(staged, seen["rows"])
        return self._enter(Load(load_id, seen["rows"], None), "batch", None)

    def merge(
        self,
        batch: DataFrame,
        load_id: str,
        cursor: str,
        month_is_fixed: bool = False,
        check: Callable[[DataFrame, int], None] | None = None,
    ) -> Load:
        """Put a batch in: one row per key, the new row wins. Skipped if in already.

        Older rows are looked for in the key columns of the whole table, within the
        key range of the batch, or only in the months of the batch if the ``month_of``
        value of a key never changes (``month_is_fixed``). ``check`` is as for ``replace``.
        """
        self._finish()
        if self.has(load_id):
            return self._entered(load_id)
        staged, seen = self._stage(batch, load_id, cursor)
        if seen["keyless"]:
            raise ValueError(f"{self.root}: load {load_id} has rows without a key")
        if check is not None:
            check(staged, seen["rows"])
        load = Load(load_id, seen["rows"], _instant(seen["newest"]))
        months = self._months_in(f"staging/{_folder(load_id)}/batch")
        present = self.by_month()
        if not month_is_fixed:
            key = F.col(self.keys[0])
            near = present.filter((key >= F.lit(seen["low"])) & (key <= F.lit(seen["high"])))
            found = near.join(staged.select(*self.keys), self.keys, "left_semi").select(MONTH).distinct()
            months = sorted({*months, *(r[0] for r in found.collect())})
        if set(self._months_in("rows")).isdisjoint(months) and not self._may_have_copies(staged):
            return self._enter(load, "batch", months)
        copied = staged.groupBy(*self.keys).count().filter("count > 1")
        single = one_per_key(staged, copied, self.keys, [cursor])
        touched = present.filter(F.col(MONTH).isin(months)).drop(MONTH)
        merged = upsert(touched, single, self.keys, arriving=staged)
        self._write(merged, f"staging/{_folder(load_id)}/merged")
        return self._enter(load, "merged", months)
