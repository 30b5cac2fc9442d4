"""Session factory and table loading used by the queries, the bench and the tests."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(app: str = "lexloom", cpus: int | None = None, **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    n = cpus or os.cpu_count() or 4
    builder = SparkSession.builder.master(f"local[{n}]").appName(app)
    for key, value in {**DEFAULTS, "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": str(n), **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables; a path Spark can read, local or not."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
