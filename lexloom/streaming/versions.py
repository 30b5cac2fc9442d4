"""New document versions as a stream: each batch of files is parsed and joins a table of nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.sources.statutes import parse_documents

FILES = "path string, modificationTime timestamp, length long, content binary"


def new_documents(spark: SparkSession, base: str) -> DataFrame:
    """A stream of (law_id, mst_id, enforcement_date, path, content) of documents that appear below ``base``."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").load(base)
    name = F.regexp_extract("path", r"([^/]+)/\1\.xml$", 1)
    return files.select(F.substring_index(name, "_", 1).alias("law_id"), F.regexp_extract(name, "^[^_]+_(.*)$", 1).alias("mst_id"), F.regexp_extract(name, r"^[^_]+_(\d{8})", 1).alias("enforcement_date"), "path", F.decode("content", "UTF-8").alias("content"))


def ingest(documents: DataFrame, table: str, checkpoint: str):
    """Start parsing the stream into a table partitioned by batch; writing a batch again replaces it, so a restart repeats nothing."""

    def write(batch: DataFrame, number: int) -> None:
        parse_documents(batch).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
