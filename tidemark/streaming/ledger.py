"""Landing place of a stream of keyed changes.

A stream only appends: each micro-batch becomes its own partition, so a batch that is run again
replaces itself, and its cost does not depend on how much is already there.

A large batch may be dealt over buckets by a hash of its keys while it is written. For that it is entered into the catalog,
until it has been applied: who reads it by its entry gets all events of a key in one task, without a shuffle. The entry is
all that is lost with the session; the files are those of any batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.storage import FILES, delete_folder, partition_values
from tidemark.streaming.triggered import start

BATCH = "_batch_id"
# Events that one bucket of a batch is laid out for, and the most files that a task keeps open for them.
BUCKET_EVENTS = 1_000_000
MOST_OPEN = 256


def append_changes(
    changes: DataFrame,
    ledger: str,
    checkpoint: str,
    interval: str | None = None,
    keys: Sequence[str] = (),
    buckets: int = 0,
) -> StreamingQuery:
    """Append a stream of changes to a ledger; the ledger and the checkpoint belong together.

    Every batch is dealt over so many ``buckets`` by its ``keys``, or over none.
    """
    write = partial(_write_batch, ledger=ledger, keys=keys, buckets=buckets)
    return start(changes.writeStream.foreachBatch(write), checkpoint, interval)


def buckets_for(spark: SparkSession, events: int) -> int:
    """Over how many buckets to deal so many events; 0 where a shuffle of them is small."""
    if events < BUCKET_EVENTS:
        return 0
    return min(max(events // BUCKET_EVENTS + 1, spark.sparkContext.defaultParallelism), MOST_OPEN)


def _write_batch(batch: DataFrame, batch_id: int, ledger: str, keys: Sequence[str], buckets: int) -> None:
    spark = batch.sparkSession
    forget_batches(spark, ledger, [batch_id])
    if buckets and not batch.isEmpty():
        folder = f"{ledger}/{BATCH}={batch_id}"
        delete_folder(spark, folder)
        # In the session of this stream only: a task keeps a file open in each bucket, instead of sorting its rows by bucket.
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(buckets))
        dealt = batch.write.format("parquet").mode("overwrite").options(**FILES).bucketBy(buckets, *keys)
        dealt.option("path", folder).saveAsTable(_entry(ledger, batch_id))
        return
    (
        batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**FILES)
        .partitionBy(BATCH)
        .parquet(ledger)
    )


def pending_batches(spark: SparkSession, ledger: str, after: int = -1) -> list[int]:
    """Micro-batches of a ledger that came after ``after``."""
    return [batch for batch in partition_values(spark, ledger, BATCH) if batch > after]


def read_batches(spark: SparkSession, ledger: str, batches: list[int], by_key: bool = True) -> DataFrame:
    """Events of these micro-batches, with the columns of all of them; others are not even listed.

    Without ``by_key`` they are read in parts of bounded size, whatever buckets they were dealt over.
    """
    if by_key and is_dealt(spark, ledger, batches):
        return spark.table(_entry(ledger, batches[0]))
    folders = [f"{ledger}/{BATCH}={batch}" for batch in batches]
    return spark.read.option("mergeSchema", "true").parquet(*folders)


def is_dealt(spark: SparkSession, ledger: str, batches: list[int]) -> bool:
    """Whether these events are read bucket by bucket: those of one batch, in the session that wrote it."""
    return len(batches) == 1 and spark.catalog.tableExists(_entry(ledger, batches[0]))


def forget_batches(spark: SparkSession, ledger: str, batches: list[int]) -> None:
    """Take the entries of these batches out of the catalog; their files stay."""
    for batch in batches:
        spark.sql(f"DROP TABLE IF EXISTS {_entry(ledger, batch)}")


def _entry(ledger: str, batch: int) -> str:
    """The name that a batch has in the catalog."""
    return f"ledger_{hashlib.sha256(ledger.encode()).hexdigest()[:16]}_{batch}"
