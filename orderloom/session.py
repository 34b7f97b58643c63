"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def builder(name: str = "orderloom") -> SparkSession.Builder:
    """A builder with the library's settings; master and sizes are the caller's."""
    b = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A one-machine session for tests and the bench."""
    spark = (
        builder()
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
