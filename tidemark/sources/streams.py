"""Streaming readers over growing Parquet folders and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def stream_path(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    max_files: int | None = None,
    name_pattern: str | None = None,
) -> DataFrame:
    """Stream the files of a folder, old and new.

    Without a schema the one merged over the present files is used, so a column that only some of them
    have is read, as NULL elsewhere. ``max_files`` bounds a micro-batch.
    """
    options = {}
    if max_files is not None:
        options["maxFilesPerTrigger"] = str(max_files)
    if name_pattern is not None:
        options["pathGlobFilter"] = name_pattern
    if schema is None:
        schema = spark.read.option("mergeSchema", "true").options(**options).parquet(path).schema
    return spark.readStream.schema(schema).options(**options).parquet(path)


def stream_table(spark: SparkSession, table: str) -> DataFrame:
    """Stream a catalog table by name."""
    return spark.readStream.table(table)
