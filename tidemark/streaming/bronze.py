"""Bronze: an append-only copy of a raw history with file lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark import names as N
from tidemark.functions.metadata import lineage_columns
from tidemark.operators.loads import last_finished, stream_history
from tidemark.sources.columns import merged_columns
from tidemark.sources.storage import FILES, make_folder
from tidemark.sources.streams import stream_path
from tidemark.streaming.triggered import measured, start

# A table's place in the layers; all other properties are the caller's.
BRONZE_PROPERTIES = {"quality": "bronze"}


def bronze_rows(
    spark: SparkSession,
    source: str,
    schema: StructType | None = None,
    max_files: int | None = None,
    name_pattern: str | None = None,
) -> DataFrame:
    """Stream of raw rows, untouched, behind the path and time of their file.

    Of a raw history only finished loads are streamed, under the columns its log keeps; any other folder is
    read under ``schema`` or the one merged over its files.
    """
    if schema is None and name_pattern is None and last_finished(spark, source) is not None:
        rows = stream_history(spark, source, max_files)
    else:
        rows = stream_path(spark, source, schema, max_files, name_pattern)
    return rows.select(*lineage_columns(), "*")


def write_bronze(
    rows: DataFrame, target: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Append a stream to Parquet files, each source file exactly once."""
    writer = rows.writeStream.format("parquet").option("path", target).options(**FILES)
    return start(writer.outputMode("append"), checkpoint, interval)


def create_bronze_table(
    spark: SparkSession,
    table: str,
    source: str,
    target: str,
    checkpoint: str,
    comment: str | None = None,
    properties: dict[str, str] | None = None,
    max_files: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Enter a bronze table into the catalog, with the columns its source has now, and start its stream.

    ``properties`` override the defaults of the same name. The table is there before its first row, and a later start
    adds the columns that have come since.
    """
    rows = bronze_rows(spark, source, max_files=max_files)
    register_table(
        spark,
        table,
        target,
        rows.schema,
        comment or f"Bronze: changes of {table} as they came in",
        {**BRONZE_PROPERTIES, **(properties or {})},
    )
    if N.RAW_COMMIT_VERSION in rows.columns:
        rows = measured(rows, F.col(N.RAW_COMMIT_VERSION))
    return write_bronze(rows, target, checkpoint, interval)


def register_table(
    spark: SparkSession,
    table: str,
    path: str,
    schema: StructType,
    comment: str,
    properties: dict[str, str],
) -> None:
    """Name a Parquet folder in the catalog; its files stay where they are.

    A table that is there already takes up the columns it lacks, and the properties. A column whose type has become
    wider, which the catalog cannot alter, has the table entered anew; a name that stands for another folder is refused.
    """
    pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
    columns = merged_columns(None, schema)
    make_folder(spark, path)
    if spark.catalog.tableExists(table):
        place = _location(spark, table)
        if place != _qualified(spark, path):
            raise ValueError(f"{table} stands for {place}")
        known = spark.table(table).schema
        columns = merged_columns(known, schema)
        added = StructType([field for field in columns if field.name not in known.names])
        if all(columns[field.name].dataType == field.dataType for field in known):
            if len(added):
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added.toDDL()})")
            if properties:
                spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
            return
        spark.sql(f"DROP TABLE {table}")
    set_properties = f"TBLPROPERTIES ({pairs})" if properties else ""
    spark.sql(
        f"CREATE TABLE {table} ({columns.toDDL()}) USING parquet LOCATION {_quoted(path)} "
        f"COMMENT {_quoted(comment)} {set_properties}"
    )


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type")
    return _qualified(spark, rows.first()[0])


def _qualified(spark: SparkSession, path: str) -> str:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
