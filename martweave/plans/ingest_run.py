"""One ingest run over all landing tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.functions.calendar import moment
from martweave.operators.ingest import VolumeRule, load_monitor, since, staleness
from martweave.sources.landed import LandedTable, Load
from martweave.sources.landing import BACKFILL_START, LANDINGS, Landing

Reader = Callable[[str, str, datetime | None], DataFrame]
REPORT = (
    "table string, load_id string, status string, rows bigint, last_value timestamp, volume string, error string"
)


class AbnormalVolume(RuntimeError):
    """A load brought far more or fewer rows than the loads before it."""


@dataclass(frozen=True)
class Freshness:
    """How old the newest row of a table with a cursor may be at ``now``."""

    now: datetime
    warn_after: timedelta
    error_after: timedelta


def landed(spark: SparkSession, root: str, landing: Landing) -> LandedTable:
    return LandedTable(
        spark,
        f"{root.rstrip('/')}/{landing.table}",
        landing.ddl,
        list(landing.keys),
        month_of=landing.cursor,
    )


def volume_status(table: LandedTable, name: str, load_id: str, rows: int, rule: VolumeRule) -> str:
    """new, normal or abnormal, for a load of ``rows`` rows after those that are in."""
    before = table.loads().select("load_id", "rows").filter(F.col("load_id") != load_id)
    now = table.spark.createDataFrame([(load_id, rows)], "load_id string, rows bigint")
    judged = load_monitor(before.unionByName(now), name, rule)
    return judged.filter(F.col("load_id") == load_id).first().status


def load_one(
    table: LandedTable,
    landing: Landing,
    read: Reader,
    load_id: str,
    first: datetime = BACKFILL_START,
    lookback: timedelta | None = None,
    check: Callable[[DataFrame, int], None] | None = None,
) -> Load:
    """Replace a snapshot table, or merge what lies at or after the cursor."""
    if landing.cursor is None:
        return table.replace(read(landing.source, landing.table, None), load_id, check)
    last_value = table.last_value()
    start = first if last_value is None else last_value - (lookback or timedelta())
    fresh = since(read(landing.source, landing.table, start), start, landing.cursor)
    load = table.merge(fresh, load_id, landing.cursor, landing.month_is_fixed, check)
    newest = max((v for v in (last_value, load.last_value) if v is not None), default=None)
    return replace(load, last_value=newest)


def run_ingest(
    spark: SparkSession,
    read: Reader,
    root: str,
    load_id: str,
    first: datetime = BACKFILL_START,
    lookback: timedelta | None = None,
    workers: int = 8,
    landings: dict[str, Landing] = LANDINGS,
    volume: VolumeRule | None = None,
    fresh: Freshness | None = None,
) -> DataFrame:
    """Load every table and return one report row each.

    ``read`` gives the rows of a (source, table) from a cursor value on, so that the
    source can push the bound into its scan. The loads are separate Spark
    jobs submitted side by side, so a small table does not wait for a large one
    and a failing one does not stop the rest: its row says ``failed``. The run
    may be repeated with the same ``load_id``; what is in already is skipped.

    With ``volume`` the rows of a load, counted while they are staged, are held
    against the loads before it; the report says new, normal or abnormal, and with
    ``volume.fail`` an abnormal load fails and the table stays as it was. With
    ``fresh`` the report has a column ``freshness``: pass, warn or error for tables with
    a cursor.
    """

    def load(landing: Landing) -> tuple:
        table = landed(spark, root, landing)
        judged: list[str | None] = [None]

        def check(_: DataFrame, rows: int) -> None:
            judged[0] = volume_status(table, landing.table, load_id, rows, volume)
            if volume.fail and judged[0] == "abnormal":
                raise AbnormalVolume(f"{landing.table}: {rows} rows are not what the loads before brought")

        try:
            done = load_one(table, landing, read, load_id, first, lookback, check if volume else None)
            return landing.table, load_id, "loaded", done.rows, done.last_value, judged[0], None
        except Exception as failure:  # reported, not hidden: see has_failed
            return landing.table, load_id, "failed", None, None, judged[0], str(failure).splitlines()[0]

    with ThreadPoolExecutor(workers) as pool:
        report = list(pool.map(load, landings.values()))
    made = spark.createDataFrame(report, REPORT)
    if fresh is None:
        return made
    age = F.timestamp_diff("SECOND", F.col("last_value"), moment(fresh.now))
    dated = F.col("table").isin([name for name, x in landings.items() if x.cursor])
    return made.withColumn("freshness", F.when(dated, staleness(age, fresh.warn_after, fresh.error_after)))


def has_failed(report: DataFrame) -> bool:
    return not report.filter("status = 'failed'").isEmpty()
