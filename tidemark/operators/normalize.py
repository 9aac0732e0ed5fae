"""From change-feed rows to raw-history rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.functions.metadata import run_columns

RAW_NAMES = {
    N.CHANGE_TYPE: N.RAW_CHANGE_TYPE,
    N.COMMIT_TIMESTAMP: N.RAW_COMMIT_TIMESTAMP,
    N.COMMIT_VERSION: N.RAW_COMMIT_VERSION,
}


def normalize_changes(changes: DataFrame) -> DataFrame:
    """Keep the row image after each change and store it under the raw names.

    Pre-images and rows without a change type are dropped; a post-image becomes an update.
    """
    kind = F.col(N.CHANGE_TYPE)
    plain = F.when(kind == N.UPDATE_POSTIMAGE, F.lit(N.UPDATE)).otherwise(kind)
    return (
        changes.where(kind != N.UPDATE_PREIMAGE)
        .withColumn(N.CHANGE_TYPE, plain)
        .withColumnsRenamed(RAW_NAMES)
    )


def tag_snapshot(
    snapshot: DataFrame,
    version: int,
    commit_timestamp: datetime | Column | None,
    source_system: str,
    run_time: Column | None = None,
) -> DataFrame:
    """Present every row of a snapshot as an insert made by the commit it was read at."""
    if commit_timestamp is None:
        raise ValueError("a snapshot needs the commit timestamp of its version")
    if not isinstance(commit_timestamp, Column):
        commit_timestamp = F.lit(commit_timestamp)
    added = {
        **run_columns(source_system, run_time),
        N.CHANGE_TYPE: F.lit(N.INSERT),
        N.COMMIT_TIMESTAMP: commit_timestamp.cast("timestamp"),
        N.COMMIT_VERSION: F.lit(version).cast("long"),
    }
    rest = [c for c in snapshot.columns if c not in added]
    return snapshot.select(*[value.alias(name) for name, value in added.items()], *rest)


def add_run_metadata(
    rows: DataFrame, source_system: str, run_time: Column | None = None
) -> DataFrame:
    """Put the run columns in front, unless the rows already carry them."""
    if N.PROCESSING_TIMESTAMP in rows.columns:
        return rows
    added = run_columns(source_system, run_time)
    rest = [c for c in rows.columns if c not in added]
    return rows.select(*[value.alias(name) for name, value in added.items()], *rest)
