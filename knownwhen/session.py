"""A local session for tests and the benchmark.

Nothing in the library depends on these settings: operators cast explicitly
and take the session they are handed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str = "knownwhen", cores: str = "*", memory: str = "16g",
                  **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        # Skips recording a Python call site for every column; planning gets faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
