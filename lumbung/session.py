"""Session settings the jobs are tuned for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that hold at any scale. Cluster sizes (executors, memory, number of
# shuffle partitions) belong to the submit command, not to the library.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A side is broadcast only when Spark's own size estimate (file sizes, or
    # the measured shuffle output under AQE) is below this bound.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    # Recording the Python call site of every expression doubles the time to build a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str = "lumbung", cpus: int | str = "*", **extra: str) -> SparkSession:
    """A single-JVM session for tests and for the benchmark."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(min(8, cores)))
    )
    for key, value in {**TUNING, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
