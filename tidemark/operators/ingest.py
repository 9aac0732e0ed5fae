"""Incremental copy of a change feed into an append-only raw history.

The only state between runs is the log of finished loads beside the raw history: the highest commit version they brought
says where to go on. A load that broke off is not in the log and is made again.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.operators.loads import append_load, last_finished, read_history
from tidemark.operators.normalize import add_run_metadata, normalize_changes, tag_snapshot
from tidemark.sources.changelog import ChangeLog

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Load:
    """What one run did. ``start`` and ``end`` are the versions read, both included."""

    kind: str
    start: int
    end: int
    rows: int

    @property
    def versions(self) -> int:
        return self.end - self.start + 1


def version_window(processed: Column, enabled: Column, latest: Column) -> dict[str, Column]:
    """Versions a run must read, given what the target holds and what the source offers.

    Starts after the last processed version, but not before the feed was enabled; a run has nothing
    to do when the source is not ahead of the target.
    """
    start = F.when(processed >= enabled, processed + 1).otherwise(enabled)
    idle = F.coalesce(latest <= processed, F.lit(False))
    return {
        "start_version": F.when(~idle, start),
        "end_version": F.when(~idle, latest),
        "versions": F.when(idle, F.lit(0)).otherwise(F.greatest(latest - start + 1, F.lit(0))),
    }


def plan_window(
    spark: SparkSession, processed: int | None, enabled: int, latest: int
) -> tuple[int, int] | None:
    """The window of one feed, or None when there is nothing to read."""
    state = [F.lit(v).cast("long") for v in (processed, enabled, latest)]
    window = version_window(*state)
    row = spark.range(0, 1, 1, 1).select(*[value.alias(name) for name, value in window.items()]).first()
    return (row["start_version"], row["end_version"]) if row["versions"] else None


def high_water_mark(history: DataFrame) -> DataFrame:
    """Highest commit version of a raw history; reads one column, NULL without rows."""
    return history.agg(F.max(N.RAW_COMMIT_VERSION).alias("version"))


def last_processed_version(spark: SparkSession, target: str) -> int | None:
    """Highest version that finished loads brought; None before the first of them, or where none had rows.

    The log of loads knows it, so no row of the history is read.
    """
    state = last_finished(spark, target)
    return None if state is None else state.high_version


def write_history(
    changes: DataFrame,
    target: str,
    source_system: str,
    run_time: Column | None = None,
    mode: str = "append",
    kind: str = "changes",
    window: tuple[int | None, int | None] = (None, None),
    feed: str = "",
) -> int:
    """Normalise changes, add run columns and write them as one load; returns the rows written.

    With ``mode`` "overwrite" the load replaces all earlier ones.
    """
    rows = add_run_metadata(normalize_changes(changes), source_system, run_time)
    return append_load(rows, target, feed, source_system, kind, window, run_time, mode == "overwrite")


def load_initial(
    log: ChangeLog,
    target: str,
    enabled_version: int,
    source_system: str,
    run_time: Column | None = None,
) -> Load:
    """Write the table as it stood before its feed began, replacing the target."""
    version = max(0, enabled_version - 1)
    snapshot = tag_snapshot(
        log.snapshot(version), version, log.commit_timestamp(version), source_system, run_time
    )
    window = version, version
    rows = write_history(snapshot, target, source_system, run_time, "overwrite", "initial", window, log.path)
    return Load("initial", *window, rows)


def load_incremental(
    log: ChangeLog,
    target: str,
    enabled_version: int,
    source_system: str,
    run_time: Column | None = None,
    latest: int | None = None,
    processed: int | None = None,
) -> Load | None:
    """Append the changes the target does not have yet; None when there are no new versions.

    ``latest`` is the last version to read, by default the last one there is; ``processed`` the last one that
    was read, by default the highest one that finished loads brought.
    """
    if latest is None:
        latest = log.latest_version()
    if latest is None:
        raise ValueError(f"{log.path} has no readable commits")
    if processed is None:
        processed = last_processed_version(log.spark, target)
    window = plan_window(log.spark, processed, enabled_version, latest)
    if window is None:
        return None
    # A window without changes adds a row to the log, but no file.
    changes = log.changes(*window)
    rows = write_history(changes, target, source_system, run_time, "append", "incremental", window, log.path)
    return Load("incremental", *window, rows)


def load_restart(
    log: ChangeLog,
    target: str,
    before: int,
    version: int,
    source_system: str,
    run_time: Column | None = None,
) -> Load:
    """Bring the target from the state after ``before`` to that after ``version``, where the feed was off between.

    Rows that differ are added as updates, new ones as inserts and missing ones as deletes, all by the
    commit ``version``; what happened in between is not known.
    """
    old, new = log.snapshot(before), log.snapshot(version)
    keys = list(log.keys)
    known = old.select(*keys, F.struct(*old.columns).alias("_old"))
    now = new.select(*keys, F.struct(*new.columns).alias("_new"))
    same = F.lit(True)
    for key in keys:
        same = same & known[key].eqNullSafe(now[key])
    both = known.join(now, same, "full").select("_old", "_new")
    shared = [name for name in new.columns if name in old.columns]
    equal = F.lit(True)
    for name in shared:
        equal = equal & F.col(f"_old.`{name}`").eqNullSafe(F.col(f"_new.`{name}`"))
    both = both.where(F.col("_old").isNull() | F.col("_new").isNull() | ~equal)
    kind = (
        F.when(F.col("_new").isNull(), N.DELETE)
        .when(F.col("_old").isNull(), N.INSERT)
        .otherwise(N.UPDATE_POSTIMAGE)
    )
    values = [
        F.when(F.col("_new").isNull(), F.col(f"_old.`{name}`")).otherwise(F.col(f"_new.`{name}`")).alias(name)
        if name in shared
        else F.col(f"_new.`{name}`").alias(name)
        for name in new.columns
    ]
    changes = both.select(
        *values,
        kind.alias(N.CHANGE_TYPE),
        F.lit(version).cast("long").alias(N.COMMIT_VERSION),
        F.lit(log.commit_timestamp(version)).cast("timestamp").alias(N.COMMIT_TIMESTAMP),
    )
    window = before + 1, version
    rows = write_history(changes, target, source_system, run_time, "append", "restart", window, log.path)
    return Load("restart", *window, rows)


def ingest(
    log: ChangeLog,
    target: str,
    source_system: str,
    run_time: Column | None = None,
    on_gap: str = "refuse",
) -> Load | None:
    """One run of a feed: a first load where none has finished, else what is new.

    Where the feed was off for some versions, a run goes up to the last one before. The next one raises an error, or
    with ``on_gap`` "restart" compares the snapshots on both sides; the one after that goes on with the feed.
    """
    if on_gap not in ("refuse", "restart"):
        raise ValueError("on_gap is refuse or restart")
    state = log.state()
    if not state["enabled"]:
        raise ValueError(f"the change feed of {log.path} is off")
    first, latest = state["first_enabled"], state["latest"]
    finished = last_finished(log.spark, target)
    intervals = log.intervals() if finished is not None else []
    if finished is None:
        load = load_initial(log, target, first, source_system, run_time)
    elif len(intervals) < 2:
        load = load_incremental(log, target, first, source_system, run_time, latest)
    else:
        done = max(finished.high_version or 0, finished.end_version or 0, first - 1)
        start, end = next((start, end) for start, end in intervals if end is None or end > done)
        if done + 1 >= start:
            last = latest if end is None else min(end, latest)
            load = load_incremental(log, target, first, source_system, run_time, last, done)
        elif on_gap == "restart":
            load = load_restart(log, target, done, start - 1, source_system, run_time)
        else:
            raise ValueError(f"the change feed of {log.path} was off for the versions {done + 1} to {start - 1}")
    logger.info("%s into %s: %s", log.path, target, load or "nothing new")
    return load
