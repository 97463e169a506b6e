"""Reading the tables of earlier steps, as a stream or as a batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from landfold.functions.sizes import ANY_AGE, rate_options
from landfold.streaming.folder import Folder

SINK_LOG = "_spark_metadata"


def table_folders(spark: SparkSession, path: str) -> list[str]:
    """Where a table's rows are: its own folder, or one folder for each flow that feeds it."""
    folder = Folder(spark, path)
    if folder.exists(SINK_LOG):
        return [path]
    flows = [n for n in folder.names() if folder.exists(f"{n}/{SINK_LOG}")]
    return [f"{path}/{n}" for n in flows] or [path]


def read_table(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = False,
    schema: T.StructType | str | None = None,
    max_files: int | None = None,
    max_bytes: int | str | None = None,
) -> DataFrame:
    """An appended table at ``path``, the rows of all its flows together.

    A folder written by a stream carries a log of committed files, which Spark
    follows: files of failed attempts are never read. Give a ``schema`` to keep
    partition values as they are declared.
    """

    def one(folder: str) -> DataFrame:
        declared = schema
        if streaming and declared is None:
            declared = spark.read.parquet(folder).schema
        reader = spark.readStream if streaming else spark.read
        if declared is not None:
            reader = reader.schema(declared)
        if streaming:
            reader = reader.options(**ANY_AGE, **rate_options(max_files, max_bytes))
        return reader.parquet(folder)

    return reduce(DataFrame.unionByName, [one(f) for f in table_folders(spark, path)])
