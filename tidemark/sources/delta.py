"""Versioned source tables in Delta format, where the session has that format."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.changelog import ChangeLog
from tidemark.sources.storage import path_exists


@dataclass(frozen=True)
class DeltaLog(ChangeLog):
    """The questions of a ``ChangeLog``, answered by the table's own feed, versions and history.

    Needs the Delta package on the session's class path; without it Spark refuses the format.
    """

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path.rstrip('/')}/_delta_log")

    def history(self) -> DataFrame:
        commits = self.spark.sql(f"DESCRIBE HISTORY delta.`{self.path}`")
        properties = F.col("operationParameters")["properties"].alias("properties")
        return commits.select("version", "timestamp", "operation", properties)

    def feed(self) -> DataFrame:
        return self._load(readChangeFeed="true", startingVersion=0)

    def changes(self, start: int, end: int) -> DataFrame:
        return self._load(readChangeFeed="true", startingVersion=start, endingVersion=end)

    def snapshot(self, version: int) -> DataFrame:
        return self._load(versionAsOf=version)

    def _load(self, **options: object) -> DataFrame:
        return self.spark.read.format("delta").options(**options).load(self.path)
