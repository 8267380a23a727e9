"""Spark settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

BYTES_PER_SHUFFLE_PARTITION = 192 * 1024 * 1024

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Session windows: merge what a task holds of a session before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions that fit an executor's memory, at least one per core. Adaptive
    execution joins small ones, so too many cost little and too few spill."""
    return max(cores, -(-shuffled_bytes // BYTES_PER_SHUFFLE_PARTITION))


def spark_session(
    name: str = "clickspark", master: str | None = None, partitions: int | None = None, **more
) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
