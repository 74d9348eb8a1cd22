"""A local session for tests and benchmarks; on a cluster, bring your own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, memory: str | None = None) -> SparkSession:
    memory = memory or os.environ.get("ORRERY_DRIVER_MEMORY", "8g")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orrery")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
