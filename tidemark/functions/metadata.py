"""Lineage and audit columns added by the layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import names as N


def run_columns(source_system: str, run_time: Column | None = None) -> dict[str, Column]:
    """Columns that say which run wrote a row. ``run_time`` defaults to the query's start."""
    moment = F.current_timestamp() if run_time is None else run_time.cast("timestamp")
    return {
        N.SOURCE_SYSTEM: F.lit(source_system),
        N.PROCESSING_TIMESTAMP: moment,
        N.PROCESSING_DATE: moment.cast("date"),
    }


def lineage_columns() -> list[Column]:
    """Path and modification time of the file a row was read from."""
    return [
        F.col("_metadata.file_path").alias(N.RAW_FILE_PATH),
        F.col("_metadata.file_modification_time").alias(N.RAW_FILE_MODIFICATION_TIME),
    ]


def silver_metadata(
    include_file_metadata: bool = False, silver_time: Column | None = None
) -> list[Column]:
    """Audit columns of a silver row; the file columns are those bronze has stored."""
    moment = F.current_timestamp() if silver_time is None else silver_time.cast("timestamp")
    columns = [F.col(c) for c in (N.RAW_CHANGE_TYPE, N.RAW_COMMIT_TIMESTAMP, N.RAW_COMMIT_VERSION)]
    columns.append(moment.alias(N.SILVER_TIMESTAMP))
    if include_file_metadata:
        columns.append(F.col(N.RAW_FILE_PATH))
        columns.append(F.col(N.RAW_FILE_MODIFICATION_TIME).alias(N.RAW_FILE_TIMESTAMP))
    return columns
