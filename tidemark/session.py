"""Session defaults: UTC, ANSI, adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tidemark", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, pass your own session to the operators instead."""
    b = SparkSession.builder.master(master).appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (defaults | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
