"""Intermediate results that are used more than once, kept where every executor can read them."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Where set, Spark deletes what a query shuffled when the query ends, not when the driver's garbage is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows up to which a narrow table goes to every task.
FEW_ROWS = 500_000


def _folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a local folder where that is unset and all runs on this machine (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        known = spark.conf.get("spark.checkpoint.dir", None)
        if known is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(known or tempfile.mkdtemp(prefix="lexloom-"))
    return sc.getCheckpointDir()


@contextlib.contextmanager
def _own_shuffles(df: DataFrame) -> Iterator[DataFrame]:
    """The rows as a query of their own, whose shuffles are deleted when it ends. Only for rows that are written: others may be read again."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        yield df.select("*")
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def durable(df: DataFrame) -> DataFrame:
    """The rows, checkpointed in the shared folder."""
    _folder(df.sparkSession)
    with _own_shuffles(df) as rows:
        return rows.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows, written as a Parquet table in the shared folder and read again. For large tables: it is compressed by column, and later steps read only the columns they use."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/table-{uuid.uuid4().hex}"
    with _own_shuffles(df) as rows:
        rows.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.held_in = path
    return out


def release(*done: DataFrame) -> None:
    """Deletes the files of what ``stored`` returned. Nothing made from it may be computed any more."""
    for df in done:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.held_in)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def lookup(df: DataFrame) -> DataFrame:
    """A table to be joined with a large one: written, and sent to every task if its rows are few, so that the large one needn't be shuffled."""
    df = durable(df)
    return F.broadcast(df) if df.count() <= FEW_ROWS else df


def running(df: DataFrame, order: list[Column], value: str) -> DataFrame:
    """Adds ``before``: the sum of a value over all rows before a row, in an order over the whole table.

    Rows lie in range partitions; a row's sum is that of the partitions before and of the
    rows before it inside its own, so no task holds more than a partition and a row for each.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = durable(df.repartitionByRange(width, *order).withColumn("part", F.spark_partition_id()))
    whole = Window.orderBy("pt").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy(F.col("part").alias("pt")).agg(F.sum(value).alias("s"))  # spark.sql.shuffle.partitions rows at most
    sums = sums.select("pt", F.coalesce(F.sum("s").over(whole), F.lit(0)).alias("s"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = parts.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(F.broadcast(sums), F.col("part") == F.col("pt")).withColumn("before", F.col("s") + F.col("inside")).drop("part", "pt", "s", "inside")
