"""Type 1 and type 2 tables kept up to date from a ledger, whatever order its events arrived in.

A table is a folder:

* ``latest/_refresh=<n>/_bucket=<b>``: the last event of every key, deletes included, dealt over buckets by a hash of the
  key. A refresh writes the buckets that have new events; all others stay where an earlier refresh put them. Readers
  take each bucket as the last finished refresh left it. The state before stays until the refresh after it is done, so
  readers keep theirs, and then goes.
* ``events/_refresh=<n>`` (type 2 only): the events that refresh ``n`` gave an end. Earlier ones are not
  read again unless an event arrives that is older than the last one of its key. Then the versions it
  changes are written once more, under ``_late=1``, where they overrule those of the same start.
* ``touched``: keys of the refresh under way; none where it fills an empty table, as it then touches all there are.
  ``refreshes``: one row per finished refresh, with the columns of the
  last events. It is written last; what an interrupted refresh leaves behind is overwritten by the next one.

So a refresh costs the new events and the buckets they fall into, not the whole table. Refresh when the stream into the
ledger has stopped without an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from tidemark import names as N
from tidemark.operators.scd import DELETES, IS_DELETE, event_intervals, last_events, scd1_events
from tidemark.operators.skew import HOT_ROWS, hot_keys
from tidemark.sources.storage import FILES, delete_folder, move_folder, partition_values, path_exists
from tidemark.streaming.ledger import forget_batches, is_dealt, pending_batches, read_batches

# Keys that a bucket is laid out for when a table is filled for the first time, and the bounds of their number.
BUCKET_KEYS = 500_000
LEAST_BUCKETS, MOST_BUCKETS = 8, 4096
# Up to so many buckets a task keeps a file open in each, and last events go to theirs without another shuffle.
OPEN_BUCKETS = 8

_REFRESH = "_refresh"
_LATE = "_late"
_OPEN = "_open"
_BUCKET = "_bucket"
_FROM = "_from"
_LAST_START = "_last_start"
_ROWS = "_rows"
_LOG_SCHEMA = "refresh long, last_batch long, has_late boolean, buckets int, columns string"


@dataclass(frozen=True)
class _Table:
    """Paths and progress of one table; ``refresh`` counts finished refreshes, ``columns`` are those of last events."""

    spark: SparkSession
    root: str
    refresh: int = 0
    last_batch: int = -1
    has_late: bool = False
    buckets: int | None = None
    columns: StructType | None = None

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> _Table:
        log = f"{root}/refreshes"
        if not path_exists(spark, log):
            return cls(spark, root)
        done = spark.read.schema(_LOG_SCHEMA).parquet(log)
        row = done.agg(
            F.max("refresh"),
            F.max("last_batch"),
            F.max("has_late"),
            F.max_by("buckets", "refresh"),
            F.max_by("columns", "refresh"),
        ).first()
        if row[0] is None:
            return cls(spark, root)
        return cls(spark, root, *row[:4], StructType.fromDDL(row[4]))

    @property
    def events_path(self) -> str:
        return f"{self.root}/events"

    @property
    def touched_path(self) -> str:
        return f"{self.root}/touched"

    @property
    def latest_path(self) -> str:
        return f"{self.root}/latest"

    def bucket(self, keys: Sequence[str]) -> Column:
        """Bucket of a row; the keys' text, so that a key whose type widens stays where it is."""
        text = [F.col(f"`{key}`").cast("string") for key in keys]
        return F.pmod(F.xxhash64(*text), F.lit(self.buckets)).cast("int")

    def versions(self) -> dict[int, list[int]]:
        """For each bucket the finished refreshes that wrote it, in order, as far as they are kept."""
        found: dict[int, list[int]] = {}
        for refresh in partition_values(self.spark, self.latest_path, _REFRESH):
            if refresh <= self.refresh:
                for bucket in partition_values(self.spark, f"{self.latest_path}/{_REFRESH}={refresh}", _BUCKET):
                    found.setdefault(bucket, []).append(refresh)
        return found

    def _rows(self, chosen: dict[int, int]) -> DataFrame:
        """The buckets as the refreshes ``chosen`` wrote them."""
        if not chosen:
            # A limit of 0 tells Spark that there is nothing to join to.
            return self.spark.createDataFrame([], self.columns).limit(0)
        folders = [f"{self.latest_path}/{_REFRESH}={refresh}/{_BUCKET}={b}" for b, refresh in sorted(chosen.items())]
        return self.spark.read.schema(self.columns).parquet(*folders)

    def latest(self, buckets: set[int] | None = None) -> DataFrame:
        """Last event of every key, or of those in some buckets."""
        return self._rows({b: done[-1] for b, done in self.versions().items() if buckets is None or b in buckets})

    def before_last_refresh(self) -> DataFrame:
        """Last events that the buckets of the last refresh held before it."""
        return self._rows({b: done[-2] for b, done in self.versions().items() if done[-1] == self.refresh and done[1:]})

    def ended(self) -> DataFrame:
        """All events that have an end, each as last written."""
        schema = f"{_REFRESH} long, {_LATE} int, {_OPEN} int, {self.columns.toDDL()}"
        if not path_exists(self.spark, self.events_path):
            return self.spark.createDataFrame([], schema).limit(0)
        events = self.spark.read.schema(schema).parquet(self.events_path)
        return events.where((F.col(_REFRESH) <= self.refresh) & (F.col(_OPEN) == 0))

    def write_latest(self, rows: DataFrame, keys: Sequence[str]) -> None:
        """Write whole buckets for the refresh under way; where there are many, each goes to few tasks, large ones to several."""
        rows = rows.withColumn(_BUCKET, self.bucket(keys))
        if self.buckets > OPEN_BUCKETS:
            rows = rows.hint("rebalance", _BUCKET)
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .options(**FILES)
            .partitionBy(_BUCKET)
            .parquet(f"{self.latest_path}/{_REFRESH}={self.refresh + 1}")
        )

    def take_open(self, place: str) -> None:
        """Move open versions, written to a folder for each bucket, behind what this refresh copied of their buckets."""
        ended = f"{place}/{_LATE}=0"
        for number in partition_values(self.spark, ended, _OPEN):
            if number:
                bucket = f"{self.latest_path}/{_REFRESH}={self.refresh + 1}/{_BUCKET}={number - 1}"
                move_folder(self.spark, f"{ended}/{_OPEN}={number}", bucket)

    def note(self, refresh: int, last_batch: int, late: bool, columns: StructType) -> None:
        """Write the row that makes a refresh count."""
        values = (refresh, last_batch, late, self.buckets, columns.toDDL())
        row = self.spark.createDataFrame([values], _LOG_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/refreshes")

    def finish(self, last_batch: int, late: bool, columns: StructType) -> None:
        self.note(self.refresh + 1, last_batch, late, columns)
        _Table.open(self.spark, self.root).clean()

    def clean(self) -> None:
        """Remove what no reader of this refresh or the one before it needs."""
        left = {refresh: 0 for refresh in partition_values(self.spark, self.latest_path, _REFRESH)}
        gone = []
        for bucket, done in self.versions().items():
            needed = done[-2:] if done[-1] == self.refresh else done[-1:]
            for refresh in done:
                left[refresh] += refresh in needed
                if refresh not in needed:
                    gone.append(f"{self.latest_path}/{_REFRESH}={refresh}/{_BUCKET}={bucket}")
        gone += [f"{self.latest_path}/{_REFRESH}={n}" for n, kept in left.items() if not kept and n < self.refresh]
        # Open versions stand among the last events.
        ended = f"{self.events_path}/{_REFRESH}={self.refresh}"
        gone += [f"{ended}/{_LATE}=0/{_OPEN}={n}" for n in partition_values(self.spark, f"{ended}/{_LATE}=0", _OPEN) if n]
        for folder in gone:
            delete_folder(self.spark, folder)


def create_scd1(
    spark: SparkSession,
    root: str,
    columns: StructType,
    keys: Sequence[str],
    sequence_by: str = N.RAW_COMMIT_TIMESTAMP,
    deletes: str = DELETES,
    buckets: int = LEAST_BUCKETS,
) -> None:
    """An empty type 1 table for events with these columns, which readers find before the first event."""
    empty = spark.createDataFrame([], columns)
    _create(spark, root, scd1_events(empty, keys, sequence_by, deletes).schema, buckets)


def create_scd2(
    spark: SparkSession,
    root: str,
    columns: StructType,
    keys: Sequence[str],
    sequence_by: str = N.RAW_COMMIT_TIMESTAMP,
    deletes: str = DELETES,
    buckets: int = LEAST_BUCKETS,
) -> None:
    """An empty type 2 table for events with these columns, which readers find before the first event."""
    empty = spark.createDataFrame([], columns)
    _create(spark, root, event_intervals(empty, keys, sequence_by, deletes, (), None).schema, buckets)


def _create(spark: SparkSession, root: str, columns: StructType, buckets: int) -> None:
    if not path_exists(spark, f"{root}/refreshes"):
        _Table(spark, root, buckets=buckets).note(0, -1, False, columns)


def refresh_scd1(
    spark: SparkSession,
    ledger: str,
    root: str,
    keys: Sequence[str],
    sequence_by: str = N.RAW_COMMIT_TIMESTAMP,
    deletes: str = DELETES,
    tie_break: Sequence[str] = (),
    buckets: int | None = None,
    least: Sequence[str] = (),
) -> bool:
    """Apply what is new in the ledger to a type 1 table; False when nothing was.

    The columns ``least`` keep the least value any event of a key had. ``buckets`` is the number that the first refresh deals the keys over, by default one for every half a
    million keys.
    """
    table, new, batches = _pending(spark, ledger, root)
    if new is None:
        return False
    table, touched, held = _write_touched(table, new, keys, sequence_by, buckets)
    if touched is None and is_dealt(spark, ledger, batches) and hot_keys(new, list(keys)) is not None:
        # One task would read all events of a hot key; in parts of bounded size each leaves one of them to be shuffled.
        new = read_batches(spark, ledger, batches, by_key=False)
    moved, kept = _split(held, touched, keys)
    events = _together(new, moved).drop(IS_DELETE)
    merged = _together(scd1_events(events, keys, sequence_by, deletes, tie_break, least), kept)
    table.write_latest(merged, keys)
    table.finish(batches[-1], False, merged.schema)
    forget_batches(spark, ledger, batches)
    return True


def refresh_scd2(
    spark: SparkSession,
    ledger: str,
    root: str,
    keys: Sequence[str],
    sequence_by: str = N.RAW_COMMIT_TIMESTAMP,
    deletes: str = DELETES,
    tie_break: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    buckets: int | None = None,
) -> bool:
    """Apply what is new in the ledger to a type 2 table; False when nothing was. ``buckets`` as for type 1."""
    table, new, batches = _pending(spark, ledger, root)
    if new is None:
        return False
    keys = list(keys)
    table, touched, held = _write_touched(table, new, keys, sequence_by, buckets)
    moved, kept = _split(held, touched, keys)
    # In an empty table no event is late, and keys are not counted.
    oldest, split_above = None, hot_rows
    # Alone, without the last events of their buckets, the new ones keep the buckets of their batch.
    dealt = touched is None and is_dealt(spark, ledger, batches)
    if touched is not None:
        is_late = F.col(_FROM) < F.col(_LAST_START)
        late = touched.where(is_late)
        # Moments cross the driver as numbers: Python would lose which of two equal clock times is meant.
        is_moment = isinstance(touched.schema[_FROM].dataType, TimestampType)
        oldest_late = F.min(F.when(is_late, F.col(_FROM)))
        found = touched.agg(
            (F.unix_micros(oldest_late) if is_moment else oldest_late).alias("oldest"),
            F.max(_ROWS).alias("most"),
        ).first()
        oldest = found["oldest"]
        # Hot keys are looked for only where a key has that many events.
        split_above = hot_rows if found["most"] >= hot_rows else None

    def intervals(events: DataFrame, split_above: int | None) -> DataFrame:
        events = events.drop(IS_DELETE, N.START_AT, N.END_AT)
        return event_intervals(events, keys, sequence_by, deletes, tie_break, split_above, dealt)

    active = _together(new, moved)
    if oldest is None:
        ended = intervals(active, split_above).withColumn(_LATE, F.lit(0))
    else:
        # The bound prunes files: versions that ended before it are left unread.
        bound = F.timestamp_micros(F.lit(oldest)) if is_moment else F.lit(oldest)
        recent = _current_ended(table, keys).where(F.col(N.END_AT) > bound)
        known = (
            _joined(recent, late, keys, "inner")
            .where(F.col(f"l.{N.END_AT}") > F.col(f"r.{_FROM}"))
            .select("l.*")
        )
        on_time = intervals(_joined(active, late, keys, "left_anti"), split_above)
        redone = intervals(_together(_joined(active, late, keys, "left_semi"), known), hot_rows)
        ended = on_time.withColumn(_LATE, F.lit(0)).unionByName(
            redone.withColumn(_LATE, F.lit(1)), allowMissingColumns=True
        )

    place = f"{table.events_path}/{_REFRESH}={table.refresh + 1}"
    is_open = F.col(N.END_AT).isNull()
    # Open versions lie apart, by bucket where a task can keep a file open in each.
    direct = table.buckets <= OPEN_BUCKETS
    number = table.bucket(keys) + 1 if direct else F.lit(1)
    (
        ended.withColumns({_LATE: F.when(is_open, 0).otherwise(F.col(_LATE)), _OPEN: F.when(is_open, number).otherwise(0)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .options(**FILES)
        .partitionBy(_LATE, _OPEN)
        .parquet(place)
    )
    opened = spark.read.parquet(place).where(F.col(_OPEN) > 0).drop(_LATE, _OPEN)
    merged = _together(opened, kept)
    if direct:
        table.write_latest(_together(opened.limit(0), kept), keys)
        table.take_open(place)
    else:
        table.write_latest(merged, keys)
    table.finish(batches[-1], oldest is not None, merged.schema)
    forget_batches(spark, ledger, batches)
    return True


def read_scd1(spark: SparkSession, root: str) -> DataFrame:
    """The rows of a type 1 table."""
    return _existing(spark, root).latest().where(~F.col(IS_DELETE)).drop(IS_DELETE)


def read_scd2(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """The versions of a type 2 table, open ones and ended ones."""
    table = _existing(spark, root)
    return _together(_current_ended(table, list(keys)), table.latest()).where(~F.col(IS_DELETE)).drop(IS_DELETE)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The open versions of a type 2 table; reads no history."""
    return read_scd1(spark, root).drop(N.START_AT, N.END_AT)


def compact_scd2(
    spark: SparkSession, root: str, target: str, keys: Sequence[str], buckets: int | None = None
) -> None:
    """Write a type 2 table anew at ``target``, without the rows that corrections overruled.

    The new table goes on where the old one stopped, with the same ledger; its keys may be dealt over another
    number of ``buckets``.
    """
    table = _existing(spark, root)
    fresh = _Table(spark, target, buckets=buckets or table.buckets)
    ended = f"{fresh.events_path}/{_REFRESH}=1/{_LATE}=0/{_OPEN}=0"
    _current_ended(table, list(keys)).write.mode("overwrite").options(**FILES).parquet(ended)
    fresh.write_latest(table.latest(), keys)
    fresh.finish(table.last_batch, False, table.columns)


def is_created(spark: SparkSession, root: str) -> bool:
    return _Table.open(spark, root).columns is not None


def refresh_count(spark: SparkSession, root: str) -> int:
    """Finished refreshes of a table."""
    return _Table.open(spark, root).refresh


def touched_keys(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """The keys that the last refresh touched."""
    return _touched(_Table.open(spark, root)).select(*keys)


def touched_rows(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Rows of the keys that the last refresh touched, as they are now; reads no bucket it did not write."""
    table = _Table.open(spark, root)
    written = {bucket for bucket, done in table.versions().items() if done[-1] == table.refresh}
    now = _joined(table.latest(written), touched_keys(spark, root, keys), keys, "left_semi")
    return now.where(~F.col(IS_DELETE)).drop(IS_DELETE)


def changed_rows(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Last events of the keys the last refresh touched, as they were before it and as they are now."""
    table = _Table.open(spark, root)
    touched = _touched(table)
    written = {bucket for bucket, done in table.versions().items() if done[-1] == table.refresh}
    both = table.latest(written).unionByName(table.before_last_refresh())
    return _joined(both, touched, keys, "left_semi")


def _touched(table: _Table) -> DataFrame:
    """A row for each key of the last refresh; all that there are where it filled an empty table."""
    if path_exists(table.spark, table.touched_path):
        return table.spark.read.parquet(table.touched_path)
    return table.latest()


def _existing(spark: SparkSession, root: str) -> _Table:
    table = _Table.open(spark, root)
    if table.columns is None:
        raise ValueError(f"{root} was neither created nor refreshed")
    return table


def _pending(
    spark: SparkSession, ledger: str, root: str
) -> tuple[_Table, DataFrame | None, list[int]]:
    """The table, the ledger events it has not seen, and the batches they came in."""
    table = _Table.open(spark, root)
    batches = pending_batches(spark, ledger, table.last_batch)
    if not batches:
        return table, None, batches
    # What is joined to last events is read in parts of bounded size, whatever buckets it was dealt over.
    return table, read_batches(spark, ledger, batches, by_key=not table.versions()), batches


def _write_touched(
    table: _Table, new: DataFrame, keys: Sequence[str], sequence_by: str, buckets: int | None
) -> tuple[_Table, DataFrame | None, DataFrame | None]:
    """Keys with new events, from when on, and where their last known event starts; and the last events of their buckets.

    Written out, because several joins use it and its size then tells Spark whether to broadcast it. A table that has
    no buckets yet gets their number. None, and nothing written, where the table has buckets but no row yet: there is
    nothing to tell the keys from.
    """
    known = {} if table.columns is None else table.versions()
    if table.columns is not None and not known:
        delete_folder(table.spark, table.touched_path)
        return table, None, table.latest()
    touched = new.groupBy(*keys).agg(
        F.min(sequence_by).alias(_FROM), F.count(F.lit(1)).alias(_ROWS)
    )
    held = None
    if table.columns is not None:
        numbers = new.select(table.bucket(keys).alias(_BUCKET)).distinct().collect()
        held = table.latest({row[_BUCKET] for row in numbers})
    if held is None:
        touched = touched.withColumn(_LAST_START, F.lit(None).cast(touched.schema[_FROM].dataType))
    else:
        last_start = F.col(f"r.{sequence_by}").alias(_LAST_START)
        touched = _joined(touched, held, keys, "left").select("l.*", last_start)
    touched.write.mode("overwrite").options(**FILES).parquet(table.touched_path)
    touched = table.spark.read.schema(touched.schema).parquet(table.touched_path)
    if table.buckets is None:
        if buckets is None:
            buckets = min(max(touched.count() // BUCKET_KEYS + 1, LEAST_BUCKETS), MOST_BUCKETS)
        table = replace(table, buckets=buckets)
    return table, touched, held


def _split(
    held: DataFrame | None, touched: DataFrame | None, keys: Sequence[str]
) -> tuple[DataFrame | None, DataFrame | None]:
    """Last events of touched keys, to be merged, and the others of their buckets, to be copied."""
    if held is None or touched is None:
        # Without a row, but with the columns, of an empty table.
        return held, held
    moved, kept = (_joined(held, touched, keys, how) for how in ("left_semi", "left_anti"))
    return moved, kept


def _current_ended(table: _Table, keys: Sequence[str]) -> DataFrame:
    """Ended events with those that late arrivals overruled left out."""
    events = table.ended()
    if not table.has_late:
        return events.drop(_REFRESH, _LATE, _OPEN)
    point = [*keys, N.START_AT]
    redone = last_events(events.where(F.col(_LATE) == 1), point, [_REFRESH])
    first = _joined(events.where(F.col(_LATE) == 0), redone, point, "left_anti")
    return first.unionByName(redone).drop(_REFRESH, _LATE, _OPEN)


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join ``l`` to ``r`` on the keys, a NULL key being equal to NULL."""
    on = [F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")) for key in keys]
    return left.alias("l").join(right.alias("r"), on, how)


def _together(rows: DataFrame, more: DataFrame | None) -> DataFrame:
    return rows if more is None else rows.unionByName(more, allowMissingColumns=True)
