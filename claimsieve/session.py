"""Session settings: a local session for tests, checks and benchmarks, and sizes for a cluster."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def cluster_settings(shuffle_bytes: int, cores: int, partition_bytes: int = 1 << 30) -> dict[str, str]:
    """Settings for a large run, to hand to ``spark-submit --conf``.

    Shuffles start with enough partitions that one fits a task's memory without spilling;
    adaptive execution merges the small ones and splits the skewed ones.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 4),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
    }


def local_session(cores: int | str | None = None, **settings: str) -> SparkSession:
    """Spark on this machine with settings sized to its cores."""
    cores = cores or os.environ.get("BENCH_CPUS") or min(8, os.cpu_count() or 1)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("claimsieve")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
