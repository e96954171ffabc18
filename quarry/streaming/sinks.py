"""Streaming sinks: a table that keeps each batch once, a memory table, and a printed one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from .replay import run_to_end


def create_table(spark: SparkSession, path: str, schema: str) -> None:
    """An empty batch table at ``path``, so that it can be read before, or without, a first batch."""
    spark.createDataFrame([], schema).write.mode("append").partitionBy("batch_id").parquet(path)


def store_batch(rows: DataFrame, path: str) -> None:
    """Write rows under their ``batch_id``: a batch that comes again replaces its own rows."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def batch_rows(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """The rows that ``store_batch`` wrote under one batch, without reading the others."""
    return stored(spark, path, schema).filter(F.col("batch_id") == batch_id)


def to_memory(stream: DataFrame, mode: str = "append", trigger: dict | None = None) -> DataFrame:
    """All rows of a stream as a driver-side table; for small results such as one row per window."""
    name = f"stream_{uuid.uuid4().hex[:12]}"
    run_to_end(stream.writeStream.outputMode(mode).format("memory").queryName(name), trigger)
    return stream.sparkSession.table(name)


def printed(stream: DataFrame, rows: int = 10, mode: str = "append") -> DataStreamWriter:
    """A writer that prints the first rows of each batch (``print`` of a stream)."""
    return stream.writeStream.outputMode(mode).format("console").option("numRows", rows).option("truncate", False)
