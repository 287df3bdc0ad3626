"""A local session for tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "dayledger", **conf: str) -> SparkSession:
    """Session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        # One small file is one scan task: shuffling such joins gives all cores work.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
