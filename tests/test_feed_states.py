"""Change logs with checkpoints, feeds that were off for a time, and feeds that fail beside others."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.feeds import at
from tests.test_ingest import CHANGES, FEED_SCHEMA, HISTORY_SCHEMA, OFF, ON, commit, image
from tidemark import names as N
from tidemark.operators import ingest, loads
from tidemark.plans import pipeline
from tidemark.sources import changelog
from tidemark.sources.changelog import ChangeLog
from tidemark.sources.feeds import Feed

UNSET = '["%s"]' % N.FEED_PROPERTY


def history_of(spark, settings, latest):
    rows = [(v, at(v), "WRITE", dict(settings).get(v)) for v in range(latest + 1)]
    return spark.createDataFrame(rows, HISTORY_SCHEMA)


@pytest.mark.parametrize(
    "settings, expected",
    [
        ([], []),
        ([(2, ON)], [(2, None)]),
        ([(0, ON), (3, OFF), (5, ON)], [(0, 2), (5, None)]),
        ([(1, OFF), (2, ON), (3, ON), (4, UNSET), (5, OFF)], [(2, 3)]),
        ([(1, ON), (2, OFF), (3, ON), (4, UNSET), (6, ON)], [(1, 1), (3, 3), (6, None)]),
    ],
)
def test_intervals_of_a_feed(spark, settings, expected):
    found = changelog.feed_intervals(history_of(spark, settings, 8)).orderBy("start_version").collect()
    assert [tuple(row) for row in found] == expected


@pytest.fixture
def gap(spark, folder):
    """On at 1, off at 3, on again at 6; the table changes all the time."""
    rows = [(i, v, kind, version, at(version)) for i, v, kind, version in CHANGES + [(5, 50, "insert", 7)]]
    history = history_of(spark, [(1, ON), (3, OFF), (6, ON)], 8)
    changelog.write_commits(spark.createDataFrame(rows, FEED_SCHEMA), history, f"{folder}/source")
    return ChangeLog(spark, f"{folder}/source", ("id",))


BEFORE_GAP = [(1, 10, "insert", 0), (2, 20, "insert", 0), (3, 30, "insert", 1), (2, 20, "delete", 2)]


def test_changes_of_a_time_off_are_not_passed_over_in_silence(spark, gap, folder):
    target = f"{folder}/raw"
    runs = [ingest.ingest(gap, target, "MRI") for _ in range(2)]
    assert [(load.kind, load.start, load.end) for load in runs] == [("initial", 0, 0), ("incremental", 1, 2)]
    for _ in range(2):
        with pytest.raises(ValueError, match="off for the versions 3 to 5"):
            ingest.ingest(gap, target, "MRI")
    assert image(loads.read_history(spark, target)) == sorted(BEFORE_GAP)
    with pytest.raises(ValueError, match="refuse or restart"):
        ingest.ingest(gap, target, "MRI", on_gap="skip")


def test_a_restart_compares_the_snapshots_on_both_sides(spark, gap, folder):
    target, runs = f"{folder}/raw", []
    while (load := ingest.ingest(gap, target, "MRI", on_gap="restart")) is not None:
        runs.append((load.kind, load.start, load.end, load.rows))
        assert len(runs) < 9
    assert runs == [("initial", 0, 0, 2), ("incremental", 1, 2, 2), ("restart", 3, 5, 2), ("incremental", 6, 8, 2)]
    met = [(1, 11, "update", 5), (4, 40, "insert", 5), (4, 40, "delete", 6), (5, 50, "insert", 7)]
    assert image(loads.read_history(spark, target)) == sorted(BEFORE_GAP + met)
    stamped = loads.read_history(spark, target).where(f"{N.RAW_COMMIT_VERSION} = 5")
    assert {r[N.RAW_COMMIT_TIMESTAMP] for r in stamped.collect()} == {at(5).replace(tzinfo=None)}


def test_a_row_that_goes_while_the_feed_is_off_is_deleted(spark, folder):
    changes = [(1, 1, "insert", 0), (2, 2, "insert", 0), (1, 1, "delete", 3), (2, None, "update_postimage", 3)]
    rows = [(i, v, kind, version, at(version)) for i, v, kind, version in changes]
    history = history_of(spark, [(0, ON), (2, OFF), (4, ON)], 5)
    changelog.write_commits(spark.createDataFrame(rows, FEED_SCHEMA), history, f"{folder}/source")
    log = ChangeLog(spark, f"{folder}/source", ("id",))
    for _ in range(6):
        ingest.ingest(log, f"{folder}/raw", "MRI", on_gap="restart")
    late = loads.read_history(spark, f"{folder}/raw").where(f"{N.RAW_COMMIT_VERSION} = 3")
    assert sorted((r["id"], r["v"], r[N.RAW_CHANGE_TYPE]) for r in late.collect()) == [(1, 1, "delete"), (2, None, "update")]


@pytest.fixture
def log(spark, folder):
    commit(spark, f"{folder}/source", CHANGES, range(8), enabled=3)
    return ChangeLog(spark, f"{folder}/source", ("id",))


def state(log, version):
    return sorted((r["id"], r["v"]) for r in log.snapshot(version).collect())


def folders(frame):
    return {part for file in frame.inputFiles() for part in file.split("/") if part.startswith("_")}


def test_snapshot_reads_the_nearest_checkpoint_and_what_follows(log):
    plain = [state(log, version) for version in range(8)]
    assert folders(log.snapshot(2)) == {"_commit_version=0", "_commit_version=1", "_commit_version=2"}
    for version in (1, 4):
        log.write_checkpoint(version)
    assert [state(log, version) for version in range(8)] == plain
    assert folders(log.snapshot(5)) == {"_version=4", "_commit_version=5"}
    assert folders(log.snapshot(4)) == {"_version=4"}
    assert folders(log.snapshot(2)) == {"_version=1", "_commit_version=2"}
    assert log.snapshot(5).columns == ["id", "v"]


def test_a_checkpoint_that_broke_off_is_not_used(spark, log, monkeypatch):
    plain = state(log, 5)
    with monkeypatch.context() as broken:
        def stop(*_):
            raise RuntimeError("lost")

        broken.setattr(changelog, "move_folder", stop)
        with pytest.raises(RuntimeError):
            log.write_checkpoint(4)
    assert log.checkpoints() == [] and state(log, 5) == plain
    log.write_checkpoint(4)
    assert log.checkpoints() == [4] and state(log, 5) == plain


def test_checkpoints_at_intervals(log, spark):
    assert log.keep_up(8) == 7 and log.keep_up(8) is None and log.checkpoints() == [7]
    commit(spark, log.path, [(9, 90, "insert", 8)], [8], extra="colour")
    assert log.keep_up(2) is None and log.keep_up(1) == 8
    commit(spark, log.path, [(9, 91, "update_postimage", 9)], [9])
    assert state(log, 9) == [(1, 11), (3, 30), (9, 91)]
    assert log.snapshot(9).columns == ["id", "v", "colour"]


def test_windows_without_folders_read_nothing(log):
    assert log.changes(90, 99).inputFiles() == [] and log.changes(90, 99).count() == 0


def test_a_bad_feed_does_not_take_the_others_with_it(spark, folder):
    found = []
    for table in ("h_region", "h_nation", "h_part"):
        feed = Feed(table, "MRI", f"{folder}/sources/{table}", f"{folder}/raw/{table}")
        found.append(feed)
        if table != "h_nation":
            commit(spark, feed.source_path, CHANGES, range(8), enabled=3)
    keys = pipeline.keys_of
    try:
        pipeline.keys_of = lambda table: ("id",)
        loaded, errors = pipeline.ingest_each(spark, found)
        with pytest.raises(pipeline.FeedsFailed, match="h_nation") as failed:
            pipeline.ingest_all(spark, found)
    finally:
        pipeline.keys_of = keys
    assert {table: load.kind for table, load in loaded.items()} == {"h_region": "initial", "h_part": "initial"}
    assert list(errors) == ["h_nation"] and "no readable commits" in str(errors["h_nation"])
    assert {table: load.kind for table, load in failed.value.loads.items()} == {"h_region": "incremental", "h_part": "incremental"}
    assert failed.value.errors.keys() == errors.keys()
    assert loads.read_history(spark, found[0].target_path).where(F.col("id") == 4).count() == 2
