from __future__ import annotations

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.feeds import at
from tidemark import names as N
from tidemark import session
from tidemark.operators import ingest, skew
from tidemark.plans import pipeline
from tidemark.session import work_folder
from tidemark.sources import changelog, feeds
from tidemark.sources.changelog import ChangeLog
from tidemark.sources.storage import table_exists

ON = '{"%s":"TRUE"}' % N.FEED_PROPERTY
OFF = '{"%s":"false"}' % N.FEED_PROPERTY
FEED_SCHEMA = "id int, v int, _change_type string, _commit_version long, _commit_timestamp timestamp"
HISTORY_SCHEMA = "version long, timestamp timestamp, operation string, properties string"

# (id, value, kind, version)
CHANGES = [
    (1, 10, "insert", 0),
    (2, 20, "insert", 0),
    (3, 30, "insert", 1),
    (2, 20, "delete", 2),
    (1, 10, "update_preimage", 4),
    (1, 11, "update_postimage", 4),
    (4, 40, "insert", 5),
    (4, 40, "delete", 6),
]


def commit(spark, path, changes, versions, enabled=None, extra=None):
    rows = [(i, v, kind, version, at(version)) for i, v, kind, version in changes]
    feed = spark.createDataFrame(rows, FEED_SCHEMA)
    if extra:
        feed = feed.withColumn(extra, F.lit("x"))
    commits = [
        (v, at(v), "SET TBLPROPERTIES", ON) if v == enabled else (v, at(v), "WRITE", None) for v in versions
    ]
    changelog.write_commits(feed, spark.createDataFrame(commits, HISTORY_SCHEMA), path)


@pytest.fixture
def log(spark, folder):
    commit(spark, f"{folder}/source", CHANGES, range(8), enabled=3)
    return ChangeLog(spark, f"{folder}/source", ("id",))


def image(rows):
    return sorted((r["id"], r["v"], r[N.RAW_CHANGE_TYPE], r[N.RAW_COMMIT_VERSION]) for r in rows.collect())


INITIAL = [(1, 10, "insert", 2), (3, 30, "insert", 2)]
INCREMENT = [(1, 11, "update", 4), (4, 40, "delete", 6), (4, 40, "insert", 5)]


@pytest.mark.parametrize(
    "processed, enabled, latest, window",
    [
        (None, 3, 7, (3, 7)),
        (2, 3, 7, (3, 7)),
        (0, 0, 4, (1, 4)),
        (4, 3, 7, (5, 7)),
        (7, 3, 7, None),
        (9, 3, 7, None),
        (2, 3, 2, None),
        (2, 3, 3, (3, 3)),
        (1, 5, 3, None),
    ],
)
def test_version_window(spark, processed, enabled, latest, window):
    assert ingest.plan_window(spark, processed, enabled, latest) == window


def test_questions_about_a_log(spark, log, folder):
    assert log.exists() and log.feed_enabled()
    assert (log.latest_version(), log.feed_start_version()) == (7, 3)
    assert log.commit_timestamp(2) == at(2)
    with pytest.raises(ValueError, match="version 99"):
        log.commit_timestamp(99)
    missing = ChangeLog(spark, f"{folder}/nowhere", ("id",))
    assert not missing.exists() and missing.latest_version() is None


def test_snapshots(log):
    def state(version):
        return sorted((r["id"], r["v"]) for r in log.snapshot(version).collect())

    assert state(0) == [(1, 10), (2, 20)]
    assert state(2) == [(1, 10), (3, 30)]
    assert state(5) == [(1, 11), (3, 30), (4, 40)]
    assert state(7) == [(1, 11), (3, 30)]
    assert log.snapshot(7).columns == ["id", "v"]


def test_range_read_prunes_partitions(log):
    changes = log.changes(4, 5)
    assert sorted(r["_commit_version"] for r in changes.collect()) == [4, 4, 5]
    plan = changes._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_commit_version[^\]]*>= 4", plan)
    assert len(changes.inputFiles()) < len(log.feed().inputFiles())
    assert log.changes(90, 99).count() == 0


def test_commits_written_without_a_shuffle(spark, folder):
    """Every task writes the versions it has, none of them gathered; the rows are the same."""
    rows = spark.range(0, 300, 1, 3).select(
        F.col("id").alias("k"), F.lit("insert").alias("_change_type"), (F.col("id") % 2).alias("_commit_version"),
        F.lit("2024-01-01").cast("timestamp").alias("_commit_timestamp"),
    )
    history = spark.sql("SELECT 0L AS version, timestamp'2024-01-01' AS timestamp, 'WRITE' AS operation, '' AS properties")
    kept = []
    for gather in (True, False):
        path = f"{folder}/{gather}"
        changelog.write_commits(rows, history, path, gather=gather)
        files = [len(list(Path(f"{path}/changes/_commit_version={v}").glob("*.zstd.parquet"))) for v in (0, 1)]
        assert files == ([1, 1] if gather else [3, 3])
        kept.append(sorted(map(tuple, ChangeLog(spark, path, ("k",)).feed().select(*rows.columns).collect())))
    assert kept[0] == kept[1] and len(kept[0]) == 300


@pytest.mark.parametrize("most", [0, 100_000])
def test_snapshot_of_one_commit_shuffles_rows_of_repeated_keys_only(spark, folder, monkeypatch, most):
    """Keys with one row, with several, with a delete, with none; also where too many repeat to be told apart."""
    monkeypatch.setattr(skew, "BROADCAST_KEYS", most)
    rows = [(k, v, "insert") for k, v in ((1, 1), (2, 2), (2, 2), (None, 4), (None, 4), (5, 5))]
    rows += [(6, 6, "delete"), (7, 7, "delete"), (7, 8, "insert"), (8, 8, "update_preimage"), (9, 9, "update_postimage"), (10, 1, None)]
    changes = spark.createDataFrame(rows, "k long, v long, _change_type string").withColumns(
        {"_commit_version": F.lit(0).cast("long"), "_commit_timestamp": F.lit("2024-01-01").cast("timestamp")}
    )
    history = spark.sql("SELECT 0L AS version, timestamp'2024-01-01' AS timestamp, 'WRITE' AS operation, '' AS properties")
    changelog.write_commits(changes, history, folder)
    seen = []
    whole = changelog.snapshot_rows
    monkeypatch.setattr(changelog, "snapshot_rows", lambda log, *more: seen.append(log.count()) or whole(log, *more))
    found = ChangeLog(spark, folder, ("k",)).snapshot(0)
    assert found.columns == ["k", "v"]
    expected = [(1, 1), (2, 2), (5, 5), (7, 8), (9, 9), (None, 4)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert seen == [6 if most else 12]


def test_feed_read_under_a_given_schema(spark, log):
    schema = log.feed().schema
    known = ChangeLog(spark, log.path, ("id",), schema=schema)
    assert known.feed().schema == schema
    assert sorted(map(str, known.changes(1, 5).collect())) == sorted(map(str, log.changes(1, 5).collect()))


def test_runs_copy_everything_once(spark, log, folder):
    target = f"{folder}/raw"
    first = ingest.ingest(log, target, "MRI")
    assert (first.kind, first.start, first.end, first.rows) == ("initial", 2, 2, 2)
    assert image(ingest.read_history(spark, target)) == INITIAL
    assert ingest.last_processed_version(spark, target) == 2

    second = ingest.ingest(log, target, "MRI")
    assert (second.kind, second.start, second.end, second.rows) == ("incremental", 3, 7, 3)
    assert second.versions == 5
    assert image(ingest.read_history(spark, target)) == sorted(INITIAL + INCREMENT)

    # Version 7 changed nothing, so it is looked at again, to no effect.
    third = ingest.ingest(log, target, "MRI")
    assert (third.start, third.end, third.rows) == (7, 7, 0)
    assert image(ingest.read_history(spark, target)) == sorted(INITIAL + INCREMENT)


def test_one_window_equals_many(spark, folder):
    source, target = f"{folder}/source", f"{folder}/raw"
    log = ChangeLog(spark, source, ("id",))
    commit(spark, source, [c for c in CHANGES if c[3] <= 3], range(4), enabled=3)
    ingest.ingest(log, target, "MRI")
    for version in range(4, 8):
        commit(spark, source, [c for c in CHANGES if c[3] == version], [version])
        ingest.ingest(log, target, "MRI")
    assert image(ingest.read_history(spark, target)) == sorted(INITIAL + INCREMENT)


def test_feed_enabled_at_creation(spark, folder):
    commit(spark, f"{folder}/source", CHANGES, range(8), enabled=0)
    log = ChangeLog(spark, f"{folder}/source", ("id",))
    load = ingest.ingest(log, f"{folder}/raw", "MRI")
    assert (load.start, load.rows) == (0, 2)
    assert ingest.ingest(log, f"{folder}/raw", "MRI").start == 1


def test_empty_first_load_goes_on_from_the_feed(spark, folder):
    changes = [(1, 10, "insert", 4), (2, 20, "insert", 5)]
    commit(spark, f"{folder}/source", changes, range(6), enabled=3)
    log = ChangeLog(spark, f"{folder}/source", ("id",))
    target = f"{folder}/raw"
    first = ingest.ingest(log, target, "MRI", F.lit("2024-03-01").cast("timestamp"))
    assert (first.kind, first.rows) == ("initial", 0)
    assert table_exists(spark, target)
    assert ingest.last_processed_version(spark, target) is None
    second = ingest.ingest(log, target, "MRI")
    assert (second.kind, second.start, second.rows) == ("incremental", 3, 2)


def test_column_added_by_a_later_commit(spark, log, folder):
    ingest.ingest(log, f"{folder}/raw", "MRI")
    commit(spark, log.path, [(9, 90, "insert", 8)], [8], extra="colour")
    ingest.ingest(log, f"{folder}/raw", "MRI")
    rows = ingest.read_history(spark, f"{folder}/raw")
    assert {r["id"]: r["colour"] for r in rows.collect()}[9] == "x"
    assert rows.where("colour is null").count() == 5


@pytest.mark.parametrize("settings", [[], [(0, ON), (2, OFF)]])
def test_disabled_feed_is_refused(spark, folder, settings):
    rows = [(0, at(0), "CREATE TABLE", None)] + [(v, at(v), "SET TBLPROPERTIES", p) for v, p in settings]
    spark.createDataFrame(rows, HISTORY_SCHEMA).write.parquet(f"{folder}/source/history")
    with pytest.raises(ValueError, match="is off"):
        ingest.ingest(ChangeLog(spark, f"{folder}/source", ("id",)), f"{folder}/raw", "MRI")


def test_feed_switched_on_again_starts_at_its_first_version(spark, folder):
    rows = [(v, at(v), "SET TBLPROPERTIES", p) for v, p in ((1, OFF), (2, ON), (3, OFF), (4, ON))]
    history = spark.createDataFrame(rows, HISTORY_SCHEMA)
    assert [r["version"] for r in changelog.feed_start(history).collect()] == [2]


def test_feeds_of_a_config():
    config = {
        "source_system": "MRI",
        "source_system_path": "/in",
        "target_system_path": "/out/mri",
        "tables": [{"table_name": "brz_region"}, {"table_name": "h_nation", "description": "any"}],
    }
    first, second = feeds.feeds_from_config(config)
    assert first == feeds.Feed("brz_region", "MRI", "/in/h_region", "/out/mri/brz_region")
    assert second == feeds.Feed("h_nation", "MRI", "/in/h_nation", "/out/mri/h_nation")


def test_failure_of_one_feed_is_raised(spark, folder):
    bad = feeds.Feed("h_region", "MRI", f"{folder}/nowhere", f"{folder}/raw")
    with pytest.raises(Exception):
        pipeline.ingest_all(spark, [bad])


class NamedSession:
    """As much of a session as choosing a folder needs."""

    applicationId = "app-1"

    def __init__(self, master, shared):
        self.sparkContext = self
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.master = master


def test_work_folder_is_under_the_shared_one(monkeypatch):
    made = []
    monkeypatch.setattr(session, "_removed_at_end", lambda _, root: made.append(root))
    cluster = NamedSession("yarn", "hdfs:///shared/")
    first, second = work_folder(cluster, "x"), work_folder(cluster, "x")
    assert first.startswith("hdfs:///shared/tidemark/app-1/x-") and first != second
    assert made == ["hdfs:///shared/tidemark/app-1"] * 2
    assert work_folder(NamedSession("local[2]", None), "x").startswith("/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(NamedSession("yarn", None), "x")


def test_commit_timestamp_keeps_microseconds(spark, folder):
    moment = dt.datetime(2024, 5, 1, 1, 2, 3, 456789, tzinfo=dt.timezone.utc)
    spark.createDataFrame([(0, moment, "WRITE", None)], HISTORY_SCHEMA).write.parquet(f"{folder}/source/history")
    assert ChangeLog(spark, f"{folder}/source", ("id",)).commit_timestamp(0) == moment
