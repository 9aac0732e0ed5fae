"""Loads that break off, and what the log of finished ones knows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.test_ingest import CHANGES, INCREMENT, INITIAL, commit, image
from tidemark import names as N
from tidemark.operators import ingest, loads
from tidemark.operators.normalize import add_run_metadata, normalize_changes
from tidemark.sources.changelog import ChangeLog
from tidemark.sources.columns import merged_columns
from tidemark.sources.storage import move_folder, partition_values, path_exists
from tidemark.sources.streams import stream_path
from tidemark.streaming.bronze import bronze_rows, write_bronze
from tidemark.streaming.triggered import finish


@pytest.fixture
def log(spark, folder):
    commit(spark, f"{folder}/source", CHANGES, range(8), enabled=3)
    return ChangeLog(spark, f"{folder}/source", ("id",))


def half_written(log, target, load, start, end):
    changes = log.changes(start, end).limit(1)
    loads.stage_load(add_run_metadata(normalize_changes(changes), "MRI"), target, load)


def test_rows_of_a_broken_load_are_seen_by_nobody_and_loaded_later(spark, log, folder):
    """The fault this is against: a window of which one version had arrived counted as done."""
    target = f"{folder}/raw"
    half_written(log, target, 0, 0, 1)
    assert loads.last_finished(spark, target) is None
    with pytest.raises(ValueError, match="no finished load"):
        loads.read_history(spark, target)
    assert ingest.ingest(log, target, "MRI").kind == "initial"
    half_written(log, target, 1, 4, 4)
    assert ingest.last_processed_version(spark, target) == 2
    assert image(loads.read_history(spark, target)) == INITIAL
    assert spark.read.parquet(target).count() == len(INITIAL)
    load = ingest.ingest(log, target, "MRI")
    assert (load.start, load.end, load.rows) == (3, 7, 3)
    assert image(loads.read_history(spark, target)) == sorted(INITIAL + INCREMENT)


@pytest.mark.parametrize("step", ["stage_load", "finish_load", "_publish"])
def test_a_run_that_stops_at_any_step_is_made_good(spark, log, folder, monkeypatch, step):
    target = f"{folder}/raw"
    ingest.ingest(log, target, "MRI")
    real = getattr(loads, step)

    def broken(*args):
        if step == "stage_load":
            real(args[0].limit(1), *args[1:])
        if step != "_publish" or args[2] == 1:
            raise RuntimeError("executor lost")
        real(*args)

    monkeypatch.setattr(loads, step, broken)
    with pytest.raises(RuntimeError):
        ingest.ingest(log, target, "MRI")
    monkeypatch.undo()
    ingest.ingest(log, target, "MRI")
    assert image(loads.read_history(spark, target)) == sorted(INITIAL + INCREMENT)
    assert spark.read.parquet(target).count() == len(INITIAL + INCREMENT)


def test_a_log_row_that_was_not_written_does_not_count(spark, log, folder):
    target = f"{folder}/raw"
    ingest.ingest(log, target, "MRI")
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(f"{target}/_loads/_load=1/_temporary")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    assert loads.last_finished(spark, target).load == 0
    assert ingest.ingest(log, target, "MRI").rows == 3
    assert loads.last_finished(spark, target).load == 1


def test_a_move_by_copies_is_carried_on(spark, folder):
    spark.range(8).repartition(4).write.parquet(f"{folder}/from")
    spark.range(0).write.parquet(f"{folder}/to")
    move_folder(spark, f"{folder}/from", f"{folder}/to")
    assert spark.read.parquet(f"{folder}/to").count() == 8 and not path_exists(spark, f"{folder}/from")
    move_folder(spark, f"{folder}/from", f"{folder}/to")


def test_log_of_loads(spark, log, folder):
    target = f"{folder}/raw"
    for _ in range(3):
        ingest.ingest(log, target, "MRI")
    found = loads.load_log(spark, target).orderBy("load").collect()
    kept = [(r["load"], r["feed"], r["source_system"], r["kind"], r["start_version"], r["end_version"], r["row_count"]) for r in found]
    assert kept == [
        (0, log.path, "MRI", "initial", 2, 2, 2),
        (1, log.path, "MRI", "incremental", 3, 7, 3),
        (2, log.path, "MRI", "incremental", 7, 7, 0),
    ]
    assert [r["finished_at"] for r in found] == sorted(r["finished_at"] for r in found)


def test_a_first_load_that_is_repeated_replaces_all(spark, log, folder):
    target = f"{folder}/raw"
    for _ in range(2):
        ingest.ingest(log, target, "MRI")
    ingest.load_initial(log, target, 3, "MRI")
    assert image(loads.read_history(spark, target)) == INITIAL
    assert partition_values(spark, target, loads.LOAD) == [2]
    assert ingest.ingest(log, target, "MRI").rows == 3
    assert image(loads.read_history(spark, target)) == sorted(INITIAL + INCREMENT)


def test_bronze_takes_finished_loads_only_and_each_once(spark, log, folder):
    target, bronze = f"{folder}/raw", f"{folder}/bronze"

    def refresh():
        finish(write_bronze(bronze_rows(spark, target), bronze, f"{folder}/checkpoint"))
        return sorted(r["id"] for r in spark.read.parquet(bronze).collect())

    ingest.ingest(log, target, "MRI")
    half_written(log, target, 1, 4, 4)
    assert refresh() == [1, 3]
    ingest.ingest(log, target, "MRI")
    assert refresh() == [1, 1, 3, 4, 4]
    assert loads.LOAD not in spark.read.parquet(bronze).columns


def test_columns_come_from_the_log_and_no_footer_is_read(spark, log, folder):
    target = f"{folder}/raw"
    ingest.ingest(log, target, "MRI")
    commit(spark, log.path, [(9, 90, "insert", 8)], [8], extra="colour")
    ingest.ingest(log, target, "MRI")
    columns = loads.history_columns(spark, target)
    assert columns.names[-1] == "colour" and loads.read_history(spark, target).columns == columns.names

    # A file that is no Parquet at all: whoever opened its footer would fail.
    hadoop = spark._jvm.org.apache.hadoop.fs
    bad = hadoop.Path(f"{target}/_load=0/{N.PROCESSING_DATE}=2000-01-01/part-0.parquet")
    files = bad.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(bad)
    stream.writeBytes("not a footer")
    stream.close()
    assert loads.read_history(spark, target).schema.names == columns.names
    assert loads.stream_history(spark, target).schema.names[-1] == "colour"
    assert ingest.ingest(log, target, "MRI") is None
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        stream_path(spark, target).schema


def test_columns_of_several_loads():
    def columns(text):
        return StructType.fromDDL(text)

    assert merged_columns(None, columns("a int")) == columns("a int")
    assert merged_columns(columns("a int, b string"), columns("c date, a bigint")) == columns("a bigint, b string, c date")
    assert merged_columns(columns("a bigint"), columns("a int")) == columns("a bigint")
    nested = merged_columns(columns("s struct<`x y`: int>"), columns("s struct<z: float>"))
    assert nested == columns("s struct<`x y`: int, z: float>") == StructType.fromDDL(nested.toDDL())
    with pytest.raises(ValueError, match="column a was int before and is string now"):
        merged_columns(columns("a int"), columns("a string"))


def test_first_load_without_rows_keeps_its_columns(spark, log, folder):
    target = f"{folder}/raw"
    rows = log.changes(0, 1).where("false")
    assert ingest.write_history(rows, target, "MRI", F.lit("2024-03-01").cast("timestamp")) == 0
    assert loads.read_history(spark, target).count() == 0
    assert spark.read.parquet(target).where(F.col("id") > 0).count() == 0
    assert ingest.last_processed_version(spark, target) is None
