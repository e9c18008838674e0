"""The incremental ingest as a stream that takes what is there and stops."""

from __future__ import annotations

from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from martweave.operators.ingest import since
from martweave.sources.landed import LandedTable


def file_stream(spark: SparkSession, path: str, ddl: str, **options: str) -> DataFrame:
    """New parquet files under a folder, or one file, read under a declared schema.

    A stream takes folders or patterns, so a single file is named by a pattern.
    A path without any file is an error, not an empty stream. ``options`` may bound a
    micro-batch (``maxFilesPerTrigger``, ``maxBytesPerTrigger``); without one it is
    a thousand files.
    """
    files = spark.read.schema(ddl).parquet(path).inputFiles()
    if not files:
        raise FileNotFoundError(f"no parquet file under {path}")
    limit = {} if "maxBytesPerTrigger" in options else {"maxFilesPerTrigger": "1000"}
    single = [unquote(f).rpartition("/")[2] for f in files] == [path.rstrip("/").rpartition("/")[2]]
    place = f"{path[:-1]}[{path[-1]}]" if single else path
    return spark.readStream.schema(ddl).options(**limit | options).parquet(place)


def stream_into(
    rows: DataFrame,
    table: LandedTable,
    checkpoint: str,
    cursor: str,
    name: str,
    first: datetime | None = None,
    month_is_fixed: bool = False,
) -> StreamingQuery:
    """Merge each micro-batch into ``table``; returns the started query.

    A batch replayed after a failure carries the same load id and is skipped if
    it was committed, so each row lands once. Late rows are merged, never dropped
    by a watermark; only what lies before ``first`` is left out. ``name`` and
    ``checkpoint`` belong together: a fresh checkpoint needs a fresh name.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, f"{name}-{batch_id}", cursor, month_is_fixed)

    return (
        (since(rows, first, cursor) if first else rows)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
