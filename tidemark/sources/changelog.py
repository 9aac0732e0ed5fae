"""Versioned source tables kept as a Parquet change log.

``<path>/changes`` holds the change feed, partitioned by commit version, so a version window reads only
its own directories. ``<path>/history`` holds one row per commit: version, timestamp, operation and
properties (a JSON object of table properties the commit set). ``<path>/columns`` holds the columns of the feed, a
row for each time they changed, so that no footer is read to learn them.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import names as N
from tidemark.operators.scd import scd1_latest
from tidemark.operators.skew import join_hot, repeated_keys
from tidemark.sources.columns import merged_columns
from tidemark.sources.storage import FILES, delete_folder, move_folder, partition_values, path_exists, table_exists

logger = logging.getLogger(__name__)

FEED_COLUMNS = (N.CHANGE_TYPE, N.COMMIT_VERSION, N.COMMIT_TIMESTAMP)
CHECKPOINT = "_version"
_POSITION = "_position"
_COLUMNS_SCHEMA = "number int, columns string"
SNAPSHOT_DELETES = f"{N.CHANGE_TYPE} = '{N.DELETE}'"


def changes_between(log: DataFrame, start: int, end: int) -> DataFrame:
    """Changes of the versions ``start`` to ``end``, both included."""
    return log.where(F.col(N.COMMIT_VERSION).between(start, end))


def snapshot_at(
    log: DataFrame, keys: Sequence[str], version: int, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Table rows as they stood after ``version``, without the feed columns."""
    return snapshot_rows(log, keys, version, tie_break).drop(*FEED_COLUMNS)


def snapshot_rows(
    log: DataFrame, keys: Sequence[str], version: int, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Table rows as they stood after ``version``, each with the feed columns of the change that left it so."""
    position = F.struct(N.COMMIT_VERSION, N.COMMIT_TIMESTAMP)
    seen = _images(log, version).withColumn(_POSITION, position)
    last = scd1_latest(seen, keys, _POSITION, SNAPSHOT_DELETES, tie_break)
    return last.drop(_POSITION)


def commit_rows(
    log: DataFrame, keys: Sequence[str], version: int, tie_break: Sequence[str] = ()
) -> DataFrame:
    """As ``snapshot_rows``, for a log of one commit, in which few keys occur twice: those alone are shuffled as rows.

    The keys of the others are all that is shuffled of them. Where many keys occur twice, all rows are.
    """
    seen = _images(log, version)
    again = repeated_keys(seen.select(*keys), keys)
    if again is None:
        return snapshot_rows(log, keys, version, tie_break)
    once = join_hot(seen, again, keys, "left_anti").where(~F.coalesce(F.expr(SNAPSHOT_DELETES), F.lit(False)))
    return once.unionByName(snapshot_rows(join_hot(seen, again, keys, "left_semi"), keys, version, tie_break))


def _images(log: DataFrame, version: int) -> DataFrame:
    """Changes up to ``version`` that say what a row was like after them."""
    return log.where((F.col(N.COMMIT_VERSION) <= version) & (F.col(N.CHANGE_TYPE) != N.UPDATE_PREIMAGE))


def feed_settings(history: DataFrame) -> DataFrame:
    """Commits that switched the change feed, with the boolean ``enabled`` they set.

    Properties that are set come as an object; those that are unset as a list of names, which turns the
    feed off like "false" does.
    """
    properties = F.from_json("properties", "map<string,string>")
    setting = F.lower(F.trim(properties[N.FEED_PROPERTY])) == "true"
    unset = F.array_contains(F.from_json("properties", "array<string>"), N.FEED_PROPERTY)
    enabled = F.coalesce(setting, F.when(unset, F.lit(False)))
    return history.select("version", "timestamp", enabled.alias("enabled")).where(
        F.col("enabled").isNotNull()
    )


def feed_start(history: DataFrame) -> DataFrame:
    """The first commit, creation included, that switched the feed on; at most one row."""
    return feed_settings(history).where("enabled").orderBy("version").select("version", "timestamp").limit(1)


def feed_intervals(history: DataFrame) -> DataFrame:
    """Versions between which the feed was on, both included; ``end_version`` is NULL while it still is.

    Switches that change nothing are passed over. A history has few switches, whatever the number of its commits.
    """
    in_order = Window.orderBy("version")
    switches = feed_settings(history).groupBy("version").agg(F.max("enabled").alias("enabled"))
    before = F.coalesce(F.lag("enabled").over(in_order), F.lit(False))
    turns = switches.withColumn("_before", before).where(F.col("enabled") != F.col("_before"))
    bounds = turns.withColumn("end_version", F.lead("version").over(in_order) - 1)
    return bounds.where("enabled").select(F.col("version").alias("start_version"), "end_version")


def last_version(history: DataFrame) -> DataFrame:
    return history.agg(F.max("version").alias("version"))


def feed_state(history: DataFrame) -> DataFrame:
    """One row: the last version, whether the feed is on now, and the version that first switched it on."""
    settings = feed_settings(history).select(F.col("version").alias("switched"), "enabled")
    rows = history.select("version").unionByName(settings, allowMissingColumns=True)
    return rows.agg(
        F.max("version").alias("latest"),
        F.coalesce(F.max_by("enabled", "switched"), F.lit(False)).alias("enabled"),
        F.min(F.when(F.col("enabled"), F.col("switched"))).alias("first_enabled"),
    )


def commit_timestamps(history: DataFrame, version: int) -> DataFrame:
    return history.where(F.col("version") == version).agg(F.max("timestamp").alias("timestamp"))


@dataclass(frozen=True)
class ChangeLog:
    """A versioned table: its feed, its commits, and questions about them.

    With a ``schema`` the feed is read under it; without one under the columns kept beside the feed. Where
    there are none either, the schemas of all files are merged, which reads every footer.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    tie_break: tuple[str, ...] = ()
    schema: StructType | None = None

    @property
    def changes_path(self) -> str:
        return f"{self.path.rstrip('/')}/changes"

    @property
    def history_path(self) -> str:
        return f"{self.path.rstrip('/')}/history"

    def exists(self) -> bool:
        return table_exists(self.spark, self.history_path)

    def history(self) -> DataFrame:
        return self.spark.read.parquet(self.history_path)

    def feed(self) -> DataFrame:
        """The whole feed, with columns that later commits added."""
        return self._read([self.changes_path])

    def changes(self, start: int, end: int) -> DataFrame:
        """Changes of the versions ``start`` to ``end``; the folders of others are not even listed.

        Changes are kept whether or not the feed was on; ``operators.ingest`` asks for none of the time it was off.
        """
        versions = partition_values(self.spark, self.changes_path, N.COMMIT_VERSION)
        folders = [f"{self.changes_path}/{N.COMMIT_VERSION}={v}" for v in versions if start <= v <= end]
        return changes_between(self._read(folders), start, end)

    def columns(self) -> StructType | None:
        """Columns of the feed, as given or as kept; None where nobody wrote them down."""
        return self.schema or kept_columns(self.spark, self.path)

    def _read(self, folders: list[str]) -> DataFrame:
        columns = self.columns()
        if columns is not None and not folders:
            return self.spark.createDataFrame([], columns)
        reader = self.spark.read.option("mergeSchema", "true")
        if columns is not None:
            reader = self.spark.read.schema(columns)
        folders = folders or [self.changes_path]
        log = reader.option("basePath", self.changes_path).parquet(*folders)
        return log.withColumn(N.COMMIT_VERSION, F.col(N.COMMIT_VERSION).cast("long"))

    def snapshot(self, version: int) -> DataFrame:
        """The table after ``version``: the nearest checkpoint before it and the changes since."""
        rows = self._since_checkpoint(version)
        versions = partition_values(self.spark, self.changes_path, N.COMMIT_VERSION)
        if not self.checkpoints() and sum(number <= version for number in versions) == 1:
            return commit_rows(rows, self.keys, version, self.tie_break).drop(*FEED_COLUMNS)
        return snapshot_at(rows, self.keys, version, self.tie_break)

    def _since_checkpoint(self, version: int) -> DataFrame:
        """Rows that decide what the table held after ``version``; folders of other versions are not even listed."""
        known = [number for number in self.checkpoints() if number <= version]
        if not known:
            return self.changes(0, version)
        place = self._checkpoint(known[-1])
        rows = self.spark.read.schema(self._checkpoint_columns(known[-1])).parquet(place)
        return rows.unionByName(self.changes(known[-1] + 1, version), allowMissingColumns=True)

    def checkpoints(self) -> list[int]:
        """Versions whose state is kept."""
        return partition_values(self.spark, self._checkpoint_log, CHECKPOINT)

    def write_checkpoint(self, version: int) -> None:
        """Keep the state after ``version``, so that later snapshots need not read what led to it.

        The row that says so is written last; a checkpoint that broke off is not used, and written again.
        """
        rows = snapshot_rows(self._since_checkpoint(version), self.keys, version, self.tie_break)
        rows.write.mode("overwrite").parquet(self._checkpoint(version))
        note = self.spark.createDataFrame([(rows.schema.toDDL(),)], "columns string").coalesce(1)
        staged = f"{self.path.rstrip('/')}/checkpoint_staging/{version}"
        note.write.mode("overwrite").parquet(staged)
        delete_folder(self.spark, f"{self._checkpoint_log}/{CHECKPOINT}={version}")
        move_folder(self.spark, staged, f"{self._checkpoint_log}/{CHECKPOINT}={version}")

    def keep_up(self, every: int) -> int | None:
        """Write a checkpoint of the last version if the one before is ``every`` versions old; returns its version."""
        latest, known = self.latest_version(), self.checkpoints()
        if latest is None or latest - (known[-1] if known else -1) < every:
            return None
        self.write_checkpoint(latest)
        return latest

    @property
    def _checkpoint_log(self) -> str:
        return f"{self.path.rstrip('/')}/checkpoint_log"

    def _checkpoint(self, version: int) -> str:
        return f"{self.path.rstrip('/')}/checkpoints/{CHECKPOINT}={version}"

    def _checkpoint_columns(self, version: int) -> StructType:
        note = self.spark.read.schema("columns string").parquet(f"{self._checkpoint_log}/{CHECKPOINT}={version}")
        return StructType.fromDDL(note.first()["columns"])

    def intervals(self) -> list[tuple[int, int | None]]:
        """First and last versions of the times the feed was on, in order."""
        rows = feed_intervals(self.history()).orderBy("start_version").collect()
        return [(row["start_version"], row["end_version"]) for row in rows]

    def state(self) -> Row:
        """``latest``, ``enabled`` and ``first_enabled`` in one look at the history."""
        if not self.exists():
            raise ValueError(f"{self.path} has no readable commits")
        return feed_state(self.history()).first()

    def latest_version(self) -> int | None:
        """Version of the last commit; None, with a warning, where there is none."""
        if not self.exists():
            logger.warning("%s has no readable commits", self.path)
            return None
        return self.state()["latest"]

    def commit_timestamp(self, version: int) -> datetime:
        micros = F.unix_micros("timestamp").alias("micros")
        found = commit_timestamps(self.history(), version).select(micros).first()["micros"]
        if found is None:
            raise ValueError(f"version {version} of {self.path} has no commit timestamp")
        return datetime.fromtimestamp(found // 1_000_000, timezone.utc).replace(
            microsecond=found % 1_000_000
        )

    def feed_enabled(self) -> bool:
        """The setting of the last commit that touched it; off where none did."""
        return self.state()["enabled"]

    def feed_start_version(self) -> int | None:
        """The first version that switched the feed on."""
        return self.state()["first_enabled"]


def kept_columns(spark: SparkSession, path: str) -> StructType | None:
    """Columns of a change log, merged over all its writes; None where they were not kept."""
    place = f"{path.rstrip('/')}/columns"
    if not path_exists(spark, place):
        return None
    columns = None
    for row in spark.read.schema(_COLUMNS_SCHEMA).parquet(place).orderBy("number").collect():
        columns = merged_columns(columns, StructType.fromDDL(row["columns"]))
    return columns


def _keep_columns(spark: SparkSession, path: str, new: StructType) -> None:
    known = kept_columns(spark, path)
    columns = merged_columns(known, new)
    if columns != known:
        rows = [(0 if known is None else len(known), columns.toDDL())]
        row = spark.createDataFrame(rows, _COLUMNS_SCHEMA).coalesce(1)
        row.write.mode("append").parquet(f"{path.rstrip('/')}/columns")


def write_commits(
    changes: DataFrame, history: DataFrame, path: str, mode: str = "append", gather: bool = True
) -> None:
    """Add commits to a change log: the changes first, then the history that makes them known.

    Changes are gathered by version, so that a folder gets few files. Without ``gather`` every task writes what it has,
    a file for each version: no shuffle where the commits are few and touch much of the table.
    """
    root = path.rstrip("/")
    _keep_columns(changes.sparkSession, root, changes.schema)
    if gather:
        changes = changes.hint("rebalance", N.COMMIT_VERSION)
    writer = changes.write.mode(mode).options(**FILES).partitionBy(N.COMMIT_VERSION)
    writer.parquet(f"{root}/changes")
    history.write.mode(mode).parquet(f"{root}/history")
