"""Reading tables and settling intermediate results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_folder

# Bytes of rows that a Python worker is given at a time; Spark's 10,000 rows may be tens of MB of texts.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(frame: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared work folder and read from there.

    Cuts the lineage: a lost executor costs only the tasks that it ran, never the work before.
    """
    spark = frame.sparkSession
    folder = work_folder(spark, name)
    # Nothing reads the shuffles again once their result is written.
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(folder)


def in_small_batches(frame: DataFrame) -> DataFrame:
    """``frame``, whose session from now on gives Python workers some ``BATCH_BYTES`` at a time at most, or one row.

    Batches stand in memory several times over, beside the heap as well as in the worker. A lower bound that
    the session has already stays.
    """
    spark = frame.sparkSession
    bound = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH))
    if not 0 < bound <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    return frame


def discard(frame: DataFrame) -> None:
    """Delete the files of a settled frame that nothing reads any more."""
    spark = frame.sparkSession
    for file in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def id_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % divisor


def renamed(frame: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the columns of ``names``, under their values: other columns cannot clash later."""
    return frame.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
