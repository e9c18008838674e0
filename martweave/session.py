"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC: dates are cut from timestamps, so the zone decides the result.
# ANSI: a malformed number fails the load instead of turning into NULL.
# AQE: right-sizes shuffles, turns joins into broadcasts once the real size of a
# side is known, and splits a hot key's partition among several tasks.
# Unions keep the tasks of their parts: Spark 4.1 would make parts of one task each a single task.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.unionOutputPartitioning": "false",
}


def session(master: str | None = None, app: str = "martweave", **extra: str) -> SparkSession:
    """A session with the library's settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster the
    executors would each write to a disk of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="martweave-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _store(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies; nothing happens if it is not there."""
    target, store = _store(spark, path)
    store.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target, store = _store(spark, path)
    return store.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, hidden names left out; none if it is not there."""
    target, store = _store(spark, path)
    names = [f.getPath().getName() for f in store.listStatus(target)] if store.exists(target) else []
    return sorted(n for n in names if n[0] not in "._")


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder."""
    target, store = _store(spark, path)
    return store.getContentSummary(target).getLength()


def advisory_size(spark: SparkSession) -> int:
    """Bytes that Spark aims at for a task's input."""
    text = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)
