from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.functions.keys import business_key, surrogate_key
from tidemark.functions.metadata import silver_metadata
from tidemark.operators import normalize
from tidemark.operators.members import with_unknown_member
from tidemark.sources.changelog import feed_settings


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_business_key_joins_text_of_columns(spark):
    row = one(
        spark,
        business_key([F.lit(7), F.lit("MRI")]),
        business_key([F.lit("a"), F.lit(None).cast("string"), F.lit(1.5)], "-", "other"),
    )
    assert row["business_key"] == "7|MRI"
    assert row["other"] == "a-1.5"


def test_business_key_takes_names_and_columns(spark):
    assert spark.range(3, 4).select(business_key(["id", F.col("id") + 1])).first()[0] == "3|4"


def test_business_key_does_not_escape_the_delimiter(spark):
    row = one(
        spark,
        business_key([F.lit("a|b"), F.lit("c")], alias="left"),
        business_key([F.lit("a"), F.lit("b|c")], alias="right"),
    )
    assert row["left"] == row["right"]


def test_business_key_refuses_bad_columns(spark):
    with pytest.raises(ValueError):
        business_key([])
    with pytest.raises(TypeError):
        business_key(["a", 1])
    with pytest.raises(TypeError):
        business_key("a")


def test_surrogate_key_of_one_and_of_several_columns(spark):
    row = (
        spark.range(1)
        .select(F.lit(1).alias("a"), F.lit(2).alias("b"), F.lit(None).cast("int").alias("gone"))
        .select(
            (surrogate_key("a") == F.xxhash64(F.lit(1))).alias("single"),
            (surrogate_key("a", "b") == F.xxhash64(F.lit("1-2"))).alias("joined"),
            (surrogate_key("a", "gone", "b") == surrogate_key("a", "b")).alias("null_skipped"),
            surrogate_key("gone").alias("seed"),
        )
        .first()
    )
    assert row["single"] and row["joined"] and row["null_skipped"]
    assert row["seed"] == 42


def feed(spark):
    kinds = ("insert", "update_preimage", "update_postimage", "delete", None)
    rows = [(1, kind, 3, "2024-01-01 00:00:00") for kind in kinds]
    return spark.createDataFrame(rows, "id int, _change_type string, _commit_version long, at string").select(
        "id", "_change_type", "_commit_version", F.col("at").cast("timestamp").alias("_commit_timestamp")
    )


def test_normalize_drops_preimages_and_renames(spark):
    rows = normalize.normalize_changes(feed(spark))
    assert rows.columns == ["id", N.RAW_CHANGE_TYPE, N.RAW_COMMIT_VERSION, N.RAW_COMMIT_TIMESTAMP]
    assert [r[N.RAW_CHANGE_TYPE] for r in rows.collect()] == ["insert", "update", "delete"]


def test_snapshot_is_tagged_as_inserts_in_front(spark):
    at = F.lit("2024-01-01").cast("timestamp")
    rows = normalize.tag_snapshot(spark.range(2), 4, at, "MRI", at)
    assert rows.columns == [
        N.SOURCE_SYSTEM, N.PROCESSING_TIMESTAMP, N.PROCESSING_DATE,
        N.CHANGE_TYPE, N.COMMIT_TIMESTAMP, N.COMMIT_VERSION, "id",
    ]
    assert {(r[N.CHANGE_TYPE], r[N.COMMIT_VERSION], r[N.SOURCE_SYSTEM]) for r in rows.collect()} == {
        ("insert", 4, "MRI")
    }
    assert dict(rows.dtypes)[N.COMMIT_VERSION] == "bigint"


def test_snapshot_needs_a_commit_timestamp(spark):
    with pytest.raises(ValueError):
        normalize.tag_snapshot(spark.range(1), 0, None, "MRI")


def test_run_columns_are_added_once(spark):
    once = normalize.add_run_metadata(spark.range(1), "MRI")
    twice = normalize.add_run_metadata(once, "OAH")
    assert once.columns[:3] == [N.SOURCE_SYSTEM, N.PROCESSING_TIMESTAMP, N.PROCESSING_DATE]
    assert twice.first()[N.SOURCE_SYSTEM] == "MRI"


def test_silver_metadata_with_and_without_file_columns(spark):
    bronze = feed(spark).transform(normalize.normalize_changes).withColumns(
        {N.RAW_FILE_PATH: F.lit("a.parquet"), N.RAW_FILE_MODIFICATION_TIME: F.current_timestamp()}
    )
    plain = [N.RAW_CHANGE_TYPE, N.RAW_COMMIT_TIMESTAMP, N.RAW_COMMIT_VERSION, N.SILVER_TIMESTAMP]
    assert bronze.select(*silver_metadata()).columns == plain
    full = bronze.select(*silver_metadata(include_file_metadata=True)).columns
    assert full == [*plain, N.RAW_FILE_PATH, N.RAW_FILE_TIMESTAMP]


def test_unknown_member_keeps_the_column_types(spark):
    members = spark.range(1).select(
        F.lit(5).alias("part_key"),
        F.lit("x").alias("name"),
        F.lit(1).cast("decimal(15,2)").alias("price"),
        F.lit(True).alias("flag"),
        F.lit("2024-01-01").cast("date").alias("day"),
        F.lit(2024).alias("year"),
    )
    both = with_unknown_member(members, year=F.lit(1900))
    assert both.dtypes == members.dtypes
    unknown = both.where("part_key = -1").first()
    assert (unknown["name"], str(unknown["price"]), unknown["flag"]) == ("Unknown", "0.00", False)
    assert (str(unknown["day"]), unknown["year"]) == ("1900-01-01", 1900)


def test_feed_that_was_unset_is_off(spark):
    on, off = '{"delta.enableChangeDataFeed":"true"}', '["delta.enableChangeDataFeed"]'
    rows = [(0, None), (1, on), (2, off), (3, '["other"]'), (4, on)]
    commits = spark.createDataFrame([(v, v, p) for v, p in rows], "version bigint, timestamp bigint, properties string")
    switched = [(row.version, row.enabled) for row in feed_settings(commits).orderBy("version").collect()]
    assert switched == [(1, True), (2, False), (4, True)]
