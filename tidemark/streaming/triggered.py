"""Streams that take in everything available and stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

_OBSERVED = "measures"
_LOG_SCHEMA = "stream string, batch long, row_count long, high_version long, finished_at timestamp"


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Start a stream: triggered once over all available data, or every ``interval``."""
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def finish(query: StreamingQuery) -> int:
    """Wait for a triggered stream; returns the rows it read."""
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def measured(rows: DataFrame, high: Column) -> DataFrame:
    """The same stream, which counts its rows and keeps the highest value of ``high`` in every micro-batch."""
    return rows.observe(_OBSERVED, F.count(F.lit(1)).alias("rows"), F.max(high).cast("long").alias("high"))


def batch_log(spark: SparkSession, query: StreamingQuery, stream: str) -> DataFrame:
    """One row per micro-batch that a measured stream has finished since its start and still knows of.

    Spark remembers ``spark.sql.streaming.numRecentProgressUpdates`` of them.
    """
    found = []
    for progress in query.recentProgress:
        seen = progress["observedMetrics"].get(_OBSERVED)
        if seen is not None and seen["rows"]:
            found.append((stream, progress["batchId"], seen["rows"], seen["high"], None))
    return spark.createDataFrame(found, _LOG_SCHEMA).withColumn("finished_at", F.current_timestamp())
