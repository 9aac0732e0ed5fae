"""Finished loads of a raw history.

Every load has a number and a folder of its own, ``_load=<n>``. It is written under ``_staging``, then noted in the log
``_loads`` by one row, and last moved to its place. The row is what makes a load count: one that broke off before it is
written again under the same number, one that broke off behind it is moved by whoever looks next. So files that
streams and readers see belong to finished loads only, and never change.

A row also keeps the columns of all loads so far. Readers and streams take them from there, so no footer is opened to
learn a schema, and the newest row alone says where the next load goes on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark import names as N
from tidemark.sources.columns import merged_columns
from tidemark.sources.storage import FILES, delete_folder, move_folder, partition_values
from tidemark.sources.streams import stream_path

LOAD = "_load"
_LOG = "_loads"
_STAGING = "_staging"
_LOG_SCHEMA = (
    "feed string, source_system string, kind string, start_version long, end_version long, row_count long, "
    "high_version long, first_load long, columns string, finished_at timestamp"
)


@dataclass(frozen=True)
class Finished:
    """The last finished load of a history, and what it says about all of them.

    ``high_version`` is the highest commit version any row has, ``end_version`` the last one that was read; loads
    before ``first`` were replaced.
    """

    load: int
    first: int
    high_version: int | None
    end_version: int | None
    columns: StructType


def _log_folder(target: str, load: int) -> str:
    return f"{target.rstrip('/')}/{_LOG}/{LOAD}={load}"


def last_finished(spark: SparkSession, target: str) -> Finished | None:
    """The newest load with a row in the log; None where there is none. A load that was not moved yet is moved."""
    for load in reversed(partition_values(spark, f"{target.rstrip('/')}/{_LOG}", LOAD)):
        row = spark.read.schema(_LOG_SCHEMA).parquet(_log_folder(target, load)).first()
        # A folder without a row belongs to a load that broke off while its row was written.
        if row is not None:
            _publish(spark, target, load)
            columns = StructType.fromDDL(row["columns"])
            return Finished(load, row["first_load"], row["high_version"], row["end_version"], columns)
    return None


def stage_load(rows: DataFrame, target: str, load: int) -> tuple[int, int | None]:
    """Write the rows of a load where nobody reads them; what an earlier attempt left there goes.

    No shuffle: every task writes what it read. Returns the number of rows and their highest commit version, both
    observed on the way.
    """
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("rows"), F.max(N.RAW_COMMIT_VERSION).alias("version")]
    (
        rows.observe(seen, *measures)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .options(**FILES)
        .partitionBy(N.PROCESSING_DATE)
        .parquet(_staged(target, load))
    )
    return seen.get["rows"], seen.get["version"]


def append_load(
    rows: DataFrame,
    target: str,
    feed: str,
    source_system: str,
    kind: str,
    window: tuple[int | None, int | None] = (None, None),
    run_time: Column | None = None,
    replace: bool = False,
) -> int:
    """Add a load, or replace all earlier ones by it; returns its rows."""
    spark = rows.sparkSession
    before = last_finished(spark, target)
    load = 0 if before is None else before.load + 1
    first = load if before is None or replace else before.first
    columns = merged_columns(None if replace or before is None else before.columns, rows.schema)
    row_count, version = stage_load(rows, target, load)
    if row_count == 0 and load == first:
        _stage_columns(rows, target, load, run_time)
    if before is not None and not replace and before.high_version is not None:
        version = max(before.high_version, before.high_version if version is None else version)
    finish_load(spark, target, load, feed, source_system, kind, window, row_count, version, first, columns)
    _publish(spark, target, load)
    if replace and before is not None:
        for old in range(before.first, load):
            delete_folder(spark, _placed(target, old))
    return row_count


def finish_load(
    spark: SparkSession,
    target: str,
    load: int,
    feed: str,
    source_system: str,
    kind: str,
    window: tuple[int | None, int | None],
    row_count: int,
    high_version: int | None,
    first: int,
    columns: StructType,
) -> None:
    """Write the row that makes a staged load count."""
    values = (feed, source_system, kind, *window, row_count, high_version, first, columns.toDDL())
    row = spark.createDataFrame([(*values, None)], _LOG_SCHEMA).withColumn("finished_at", F.current_timestamp())
    row.coalesce(1).write.mode("overwrite").parquet(_log_folder(target, load))


def load_log(spark: SparkSession, target: str) -> DataFrame:
    """One row per finished load: its number, feed, source system, kind, version window, rows and time."""
    schema = f"{_LOG_SCHEMA}, {LOAD} int"
    rows = spark.read.schema(schema).parquet(f"{target.rstrip('/')}/{_LOG}")
    return rows.select(
        F.col(LOAD).cast("long").alias("load"),
        *["feed", "source_system", "kind", "start_version", "end_version", "row_count", "finished_at"],
    )


def read_history(spark: SparkSession, target: str) -> DataFrame:
    """A raw history with the columns of all its finished loads."""
    state = last_finished(spark, target)
    if state is None:
        raise ValueError(f"{target} has no finished load")
    rows = spark.read.schema(_with_load(state.columns)).parquet(target)
    return rows.where(F.col(LOAD).between(state.first, state.load)).select(*_quoted(state.columns))


def history_columns(spark: SparkSession, target: str) -> StructType:
    """Columns of all finished loads, without a look into any of their files."""
    state = last_finished(spark, target)
    if state is None:
        raise ValueError(f"{target} has no finished load")
    return state.columns


def stream_history(spark: SparkSession, target: str, max_files: int | None = None) -> DataFrame:
    """Stream the files of finished loads, each once, with the columns of all loads at the time of the start."""
    columns = history_columns(spark, target)
    return stream_path(spark, target, _with_load(columns), max_files).select(*_quoted(columns))


def _with_load(columns: StructType) -> StructType:
    return StructType([*columns, StructField(LOAD, IntegerType())])


def _quoted(columns: StructType) -> list[Column]:
    return [F.col(f"`{name}`") for name in columns.names]


def _staged(target: str, load: int) -> str:
    return f"{target.rstrip('/')}/{_STAGING}/{load}"


def _placed(target: str, load: int) -> str:
    return f"{target.rstrip('/')}/{LOAD}={load}"


def _publish(spark: SparkSession, target: str, load: int) -> None:
    """Move a noted load to its place, as far as that has not been done."""
    move_folder(spark, _staged(target, load), _placed(target, load))


def _stage_columns(rows: DataFrame, target: str, load: int, run_time: Column | None) -> None:
    """Leave a file without rows behind an empty first load, so that anyone can read its columns."""
    today = F.current_date() if run_time is None else run_time.cast("date")
    day = rows.sparkSession.range(0, 1, 1, 1).select(today.alias("day")).first()["day"]
    empty = rows.drop(N.PROCESSING_DATE).limit(0)
    empty.write.mode("append").parquet(f"{_staged(target, load)}/{N.PROCESSING_DATE}={day}")
