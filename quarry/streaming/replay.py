"""Replay sources: a table written as files that a streaming file source
reads (any other streaming source plugs in the same way).

Files go under the shared checkpoint folder (``spark.checkpoint.dir``), never a
machine-local path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..session import scratch_path

#: Column that names the folders of a keyed replay.
_FOLDER = "replay_key"


def new_run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def write_source(df: DataFrame, path: str) -> str:
    """``df`` as files of any cut, for consumers whose result does not depend on batch boundaries."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_by_key(df: DataFrame, key: str, path: str) -> str:
    """One folder per value of ``key``, written by as many tasks as its rows need; the files keep the column.

    Rows are dealt by key with the rebalance hint: adaptive execution splits
    the rows of a large key into partitions of the advisory size and joins
    small keys, so no task holds a whole large key and small keys stay few files.
    """
    marked = df.withColumn(_FOLDER, F.col(key).cast("string"))
    marked.hint("rebalance", F.col(_FOLDER)).write.mode("overwrite").partitionBy(_FOLDER).parquet(path)
    return path


def key_folders(spark: SparkSession, path: str, schema: StructType, key: str) -> list[str]:
    """Folders of ``write_by_key`` in ascending order of the key, null first:
    one name per key value on the driver, no data rows."""
    folder = F.regexp_replace("file", "/[^/]*$", "")
    rows = spark.read.schema(StructType([*schema.fields, StructField(_FOLDER, StringType())])).parquet(path)
    value = F.col(_FOLDER).cast(schema[key].dataType)
    files = rows.select(value.alias("value"), F.col("_metadata.file_path").alias("file")).distinct()   # cut once a file, not a row
    names = files.select("value", folder.alias("folder")).distinct()
    return [r["folder"] for r in names.orderBy(F.col("value").asc_nulls_first(), "folder").collect()]


def only(folders: list[str]) -> str:
    """A pattern of these folders, which lie in one folder. A query that goes
    on with another pattern keeps its checkpoint: files are known by their own paths."""
    parent = folders[0].rsplit("/", 1)[0]
    return f"{parent}/{{{','.join(f.rsplit('/', 1)[1] for f in folders)}}}"


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet file stream of a folder, or of several by a pattern."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_text_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Line stream (``value``) from text files, like a socket text stream."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def run_to_end(writer: DataStreamWriter, trigger: dict | None = None) -> StreamingQuery:
    """Start a query, wait until it has handled all that its source holds, and stop it.

    Without ``trigger`` it runs as ``availableNow``. A ``processingTime`` trigger, which by
    itself runs on for ever, is stopped once nothing is left; a batch under way is finished first.
    """
    trigger = trigger or {"availableNow": True}
    query = writer.trigger(**trigger).start()
    if "processingTime" in trigger:
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    else:
        query.awaitTermination()
    return query
