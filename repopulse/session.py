"""Session settings: those that results depend on, and those that a large cluster needs."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Results depend on these. A day is a UTC day, a bad cast raises, and a JSON object that
# repeats a key keeps the last value.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.enforceReservedKeywords": "false",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Runtime re-planning: merge small shuffle partitions, split skewed join partitions, and
# broadcast a join side only once its measured size is below the threshold. Timestamps are stored
# in the form that has file statistics.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

MB = 1024 * 1024

# File bytes per scan task. Counts read a few narrow columns of Parquet, a small part of the file, so
# 1 GB: 100 TB make 100,000 tasks. JSON lines and whole staged tables are read to the last byte.
SCAN_BYTES = {"narrow": "1g", "whole": "256m"}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the result settings on a session that somebody else started."""
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions(shuffle_bytes: int, cores: int) -> int:
    """Initial number of shuffle partitions for an expected shuffle volume.

    About 128 MB each, so that a partition sorts and aggregates in executor memory, and at least
    one per core. Adaptive execution merges whatever turns out small.
    """
    return max(cores, -(-shuffle_bytes // (128 * MB)))


def cluster_session(
    app: str = "repopulse",
    shuffle_bytes: int = 0,
    cores: int = 8,
    extra: dict[str, str] | None = None,
    scan: str = "narrow",
) -> SparkSession:
    """Session for a scheduled run. The master comes from `spark-submit`; `scan` says how much of
    its files a run reads."""
    settings = {
        **CLUSTER_SETTINGS,
        "spark.sql.files.maxPartitionBytes": SCAN_BYTES[scan],
        **RESULT_SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions(shuffle_bytes, cores)),
        **(extra or {}),
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int = 8, app: str = "repopulse", extra: dict[str, str] | None = None) -> SparkSession:
    """Session on this machine, for tests and the benchmark."""
    settings = {
        **RESULT_SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "8g",
        **(extra or {}),
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str | None = None, root: str | None = None) -> str:
    """A folder name below the shared folder the cluster names in `spark.checkpoint.dir`: a new one,
    or that of `name`. `root` is used where the setting is missing, and must be as reachable."""
    root = spark.conf.get("spark.checkpoint.dir", None) or root
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{root.rstrip('/')}/repopulse-{name or uuid.uuid4().hex}"
