"""Times the headline queries and prints one JSON line.

Each query is written to the no-op sink, so that every column is computed and none
is fetched; the figure is the median of three runs after a first one that warms up.
The value sums the headline queries alone, so that it can be compared between rounds.
Timestamps stay timestamps: printing them as text is no part of a query.
"""

from __future__ import annotations

import importlib
import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from martweave.session import session  # noqa: E402

HEADLINE = (
    "fct_order_items",
    "fct_orders",
    "merge_upsert",
    "star_month_country",
    "metric_coherence",
    "metric_margin_by_brand",
    "metric_delivery_days",
    "metric_conversion",
    "dq_unique",
    "dq_relationships",
    "stg_users",
    "orphans_by_day",
)
# Whole runs write stored tables; they are timed once, after the others have warmed up.
WHOLE = ("ingest_run", "landed_upsert", "build_run", "ingest_stream")
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        f"local[{cpus}]",
        "bench",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = importlib.import_module("__spark_entry__").plain_queries()
    seconds = {}
    for name in (*HEADLINE, *WHOLE):
        times = []
        for _ in range(1 if name in WHOLE else RUNS + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 4)
    print(
        json.dumps(
            {
                "metric": "sum of median seconds of the headline queries",
                "value": round(sum(seconds[name] for name in HEADLINE), 4),
                "whole_runs": round(sum(seconds[name] for name in WHOLE), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "runs": RUNS,
                "cpus": cpus,
                "spark": spark.version,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
