"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Everything here is a plain Spark setting; a cluster may override any of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("waymill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
