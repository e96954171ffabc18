"""File readers and writers: delimited text, raw lines, whole files with
their path, in-memory rows, matrix sinks, and named / persisted data sets.

Schemas are always given explicitly (no inference pass over the data)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_delimited(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",",
                   header: bool = False, quote: str = '"') -> DataFrame:
    """Comma / pipe / tab separated text with a declared schema. Malformed
    fields become null (PERMISSIVE) instead of failing the job."""
    return (spark.read.schema(schema).option("sep", sep).option("header", header)
            .option("quote", quote).option("mode", "PERMISSIVE").csv(path))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value``."""
    return spark.read.text(path)


def read_whole_files(spark: SparkSession, path_glob: str) -> DataFrame:
    """One row per file: (path, text)."""
    return (spark.read.text(path_glob, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def label_from_path(path: Column) -> Column:
    """Name of the file's parent directory (the topic of a post)."""
    return F.element_at(F.split(path, "/"), -2)


def strip_scheme(path: Column) -> Column:
    """Drop a leading ``file:`` (and the slashes that follow it but one)."""
    return F.regexp_replace(path, r"^file:(//)?", "")


def from_rows(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    """In-memory rows (small driver-side collections only)."""
    return spark.createDataFrame(rows, schema)


def write_matrix(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a long matrix (row/component, index, value) as CSV or Parquet."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def persist_named(df: DataFrame, name: str, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Persist and register under a name (the temp view is how SQL users see it)."""
    df = df.persist(level)
    df.createOrReplaceTempView(name)
    return df


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut a long lineage by writing to the shared checkpoint folder
    (``spark.checkpoint.dir``); survives executor loss, unlike local
    checkpoints."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: later jobs scan the files (with real file-size statistics
    for join planning) instead of recomputing the lineage, and a lost
    executor re-reads files rather than redoing the work."""
    import uuid
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files that ``materialise`` wrote for ``df``, which no later step reads. Tables outside the shared
    checkpoint folder are left alone."""
    from ..session import ensure_checkpoint_dir
    spark = df.sparkSession
    base = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(base.toUri().getPath().rstrip("/") + "/"):
            fs.delete(path, True)
