"""Session builder shared by the command line tools, tests and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app_name: str = "cairnframe", cpus: int | None = None) -> SparkSession:
    """A local session with the settings the engine expects; on a cluster `spark-submit` sets them."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CAIRN_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
