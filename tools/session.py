"""The local session of tests, tools and bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(cpus: int | None = None) -> SparkSession:
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{n}]").appName("postmill")
        .config("spark.sql.shuffle.partitions", str(n)).config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
