from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.sources.streams import stream_path, stream_table
from tidemark.streaming import bronze
from tidemark.streaming.triggered import finish, start


@pytest.fixture
def source(spark, folder):
    path = f"{folder}/raw"
    spark.range(10).withColumn("v", F.lit("a")).write.partitionBy("v").parquet(path)
    return path


def test_bronze_takes_each_file_once(spark, folder, source):
    def run():
        rows = bronze.bronze_rows(spark, source)
        return finish(bronze.write_bronze(rows, f"{folder}/bronze", f"{folder}/checkpoint"))

    assert (run(), run()) == (10, 0)
    spark.range(10, 15).withColumn("v", F.lit("b")).write.mode("append").partitionBy("v").parquet(source)
    assert run() == 5
    rows = spark.read.parquet(f"{folder}/bronze")
    assert rows.columns == [N.RAW_FILE_PATH, N.RAW_FILE_MODIFICATION_TIME, "id", "v"]
    assert rows.select("id").distinct().count() == rows.count() == 15
    assert rows.where(f"{N.RAW_FILE_PATH} not like '%/raw/v=%' or {N.RAW_FILE_MODIFICATION_TIME} is null").count() == 0


def test_bronze_table_has_properties_and_streams_on(spark, folder, source):
    query = bronze.create_bronze_table(
        spark, "stbl_numbers", source, f"{folder}/bronze", f"{folder}/checkpoint", properties={"quality": "trial", "team": "orders"}
    )
    finish(query)
    shown = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES stbl_numbers").collect()}
    assert shown["quality"] == "trial"
    assert shown["team"] == "orders" and not [key for key in shown if key.startswith(("delta.", "pipelines."))]
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED stbl_numbers").collect()}
    assert described["Comment"].startswith("Bronze: ")
    writer = stream_table(spark, "stbl_numbers").select("id").writeStream.format("parquet")
    finish(start(writer.option("path", f"{folder}/silver"), f"{folder}/checkpoint-silver"))
    assert spark.read.parquet(f"{folder}/silver").count() == 10
    spark.sql("DROP TABLE stbl_numbers")


def test_stream_reads_columns_of_all_files(spark, folder):
    spark.range(3).write.parquet(f"{folder}/in")
    spark.range(3, 5).withColumn("extra", F.lit(1)).write.mode("append").parquet(f"{folder}/in")
    writer = stream_path(spark, f"{folder}/in", max_files=1).writeStream.format("parquet")
    assert finish(start(writer.option("path", f"{folder}/out"), f"{folder}/checkpoint")) == 5
    rows = spark.read.parquet(f"{folder}/out")
    assert rows.where("extra is null").count() == 3


def test_bronze_table_takes_up_new_columns(spark, folder):
    """Read by its name after a second load; the table keeps its place and its properties."""
    def refresh(rows, **more):
        rows.write.mode("append").parquet(f"{folder}/raw")
        finish(bronze.create_bronze_table(spark, "brz_grown", f"{folder}/raw", f"{folder}/bronze", f"{folder}/checkpoint", **more))
        return spark.table("brz_grown").drop(N.RAW_FILE_PATH, N.RAW_FILE_MODIFICATION_TIME)

    first = refresh(spark.range(3), properties={"team": "a"})
    assert first.columns == ["id"] and first.count() == 3
    odd = F.struct(F.lit(1).alias("x y")).alias("s")
    second = refresh(spark.range(3, 5).select("id", F.lit("new").alias("extra"), odd), properties={"owner team": "b"})
    assert second.columns == ["id", "extra", "s"]
    assert sorted((r["id"], r["extra"], r["s"] and r["s"]["x y"]) for r in second.collect()) == [
        (0, None, None), (1, None, None), (2, None, None), (3, "new", 1), (4, "new", 1)
    ]
    shown = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES brz_grown").collect()}
    assert (shown["team"], shown["owner team"], shown["quality"]) == ("a", "b", "bronze")
    with pytest.raises(ValueError, match="stands for"):
        bronze.register_table(spark, "brz_grown", f"{folder}/elsewhere", second.schema, "", {})
    spark.sql("DROP TABLE brz_grown")


def test_table_whose_column_became_wider_is_entered_anew(spark, folder):
    for kind in ("int", "bigint"):
        rows = spark.range(2).select(F.col("id").cast(kind).alias("k"))
        rows.write.mode("append").parquet(f"{folder}/t")
        bronze.register_table(spark, "brz_wider", f"{folder}/t", rows.schema, "a table", {})
    assert spark.table("brz_wider").dtypes == [("k", "bigint")] and spark.table("brz_wider").count() == 4
    with pytest.raises(ValueError, match="column k"):
        bronze.register_table(spark, "brz_wider", f"{folder}/t", spark.range(1).selectExpr("'x' AS k").schema, "", {})
    spark.sql("DROP TABLE brz_wider")


def test_named_table_can_be_read_before_its_first_row(spark, folder):
    bronze.register_table(spark, "brz_early", f"{folder}/t", spark.range(1).schema, "a table", {})
    assert spark.table("brz_early").count() == 0
    writer = stream_table(spark, "brz_early").writeStream.format("parquet")
    assert finish(start(writer.option("path", f"{folder}/out"), f"{folder}/checkpoint")) == 0
    spark.sql("DROP TABLE brz_early")
