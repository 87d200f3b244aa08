"""Stage tables: Parquet between the stages, and results kept for reuse."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A stage's output. Without a schema it is taken from the file footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, *partitions: str, mode: str = "overwrite") -> DataFrame:
    """Writes a stage's output, by default replacing what the path held, and reads it back."""
    df.write.mode(mode).partitionBy(*partitions).parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store Spark reads it from."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for data that must outlive an executor.

    Without ``spark.checkpoint.dir`` it is a folder in the session's warehouse, which
    driver and executors share as well. The session's settings are left alone.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_kept"


def keep(df: DataFrame) -> DataFrame:
    """Writes a result that is read more than once and returns it as a table.

    Used after external calls, which a recomputed plan would make again. The
    write runs the plan once and survives the loss of any executor.
    """
    path = f"{shared_folder(df.sparkSession)}/revlens-{uuid.uuid4().hex}"
    return write_table(df, path)
