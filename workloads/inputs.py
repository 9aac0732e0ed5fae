"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.functions.keys import business_key
from tidemark.operators.normalize import normalize_changes
from tidemark.plans.silver import ENTITIES, clean

# Moments the derived tables carry; the checking SQL uses the same.
LOAD_TIME = "2024-02-01 06:00:00"
RUN_TIME = "2024-02-01 12:00:00"
FIRST_EVENT_DAY = "2024-01-01"
FEED_ENABLED_AT = 5
USER_KEYS = ("user_id",)
USER_COLUMNS = ("user_id", "event_id", "value")


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- business tables ------------------------------------------------------------------------------


def _made_up(key: str, *columns: str) -> dict[str, Column]:
    """Text columns the given tables lack, made from the row's key."""
    return {c: F.concat(F.lit("x-"), F.col(key).cast("string")) for c in columns}


def source_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One business table with all the columns its silver entity expects."""
    if name == "customer" or name == "customer_narrow":
        rows = table(spark, sf_dir, "customer")
        return rows.withColumns(_made_up("c_custkey", "c_address", "c_phone", "c_comment"))
    if name == "nation":
        return table(spark, sf_dir, "nation").withColumns(_made_up("n_nationkey", "n_comment"))
    if name == "region":
        return table(spark, sf_dir, "region").withColumns(_made_up("r_regionkey", "r_comment"))
    if name == "part":
        rows = table(spark, sf_dir, "part")
        return rows.withColumns(_made_up("p_partkey", "p_mfgr", "p_container", "p_comment"))
    if name == "supplier":
        rows = table(spark, sf_dir, "supplier")
        return rows.withColumns(_made_up("s_suppkey", "s_address", "s_phone", "s_comment"))
    if name == "order":
        rows = table(spark, sf_dir, "orders").withColumns(
            _made_up("o_orderkey", "o_clerk", "o_comment")
        )
        return rows.withColumn("o_shippriority", F.lit(0))
    if name == "partsupp":
        lines = table(spark, sf_dir, "lineitem")
        rows = lines.groupBy(
            F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")
        ).agg(
            F.sum("l_quantity").cast("int").alias("ps_availqty"),
            F.min("l_extendedprice").alias("ps_supplycost"),
        )
        return rows.withColumns(_made_up("ps_partkey", "ps_comment"))
    raise KeyError(name)


def bronze_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The business table as its first load leaves it in bronze."""
    return source_rows(spark, sf_dir, name).withColumns(
        {
            N.SOURCE_SYSTEM: F.lit(ENTITIES[name].source_system),
            N.RAW_CHANGE_TYPE: F.lit(N.INSERT),
            N.RAW_COMMIT_TIMESTAMP: moment(LOAD_TIME),
            N.RAW_COMMIT_VERSION: F.lit(0).cast("long"),
        }
    )


def silver_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The cleaned business table, every row current."""
    return clean(bronze_rows(spark, sf_dir, name), ENTITIES[name], moment(RUN_TIME))


# --- change feed of users -------------------------------------------------------------------------


def user_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed of a user table: one event, one change; one day, one commit version."""
    events = table(spark, sf_dir, "events")
    kind = (
        F.when(F.col("event_type") == "signup", N.INSERT)
        .when(F.col("event_type") == "error", N.DELETE)
        .otherwise(N.UPDATE_POSTIMAGE)
    )
    day = F.col("ts").cast("date")
    return events.select(
        *USER_COLUMNS,
        kind.alias(N.CHANGE_TYPE),
        F.datediff(day, F.lit(FIRST_EVENT_DAY).cast("date")).cast("long").alias(N.COMMIT_VERSION),
        F.col("ts").cast("timestamp").alias(N.COMMIT_TIMESTAMP),
    )


def user_feed_with_preimages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user feed with a pre-image row, of a value one lower, before each update."""
    feed = user_feed(spark, sf_dir)
    after = F.struct(F.col("value").alias("value"), F.col(N.CHANGE_TYPE).alias("kind"))
    before = F.struct((F.col("value") - 1).alias("value"), F.lit(N.UPDATE_PREIMAGE).alias("kind"))
    is_update = F.col(N.CHANGE_TYPE) == N.UPDATE_POSTIMAGE
    images = F.when(is_update, F.array(before, after)).otherwise(F.array(after))
    return feed.withColumn("_image", F.explode(images)).select(
        *[c for c in USER_COLUMNS if c != "value"],
        F.col("_image.value").alias("value"),
        F.col("_image.kind").alias(N.CHANGE_TYPE),
        N.COMMIT_VERSION,
        N.COMMIT_TIMESTAMP,
    )


def tied_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user feed with all changes of a day committed at its start."""
    feed = user_feed(spark, sf_dir)
    return feed.withColumn(N.COMMIT_TIMESTAMP, F.date_trunc("day", N.COMMIT_TIMESTAMP))


def user_changes(feed: DataFrame) -> DataFrame:
    """A feed as silver sees it: normalised, with business key."""
    changes = normalize_changes(feed).withColumn(N.SOURCE_SYSTEM, F.lit("MRI"))
    return changes.select(
        business_key([*USER_KEYS, N.SOURCE_SYSTEM]),
        *USER_COLUMNS,
        N.RAW_CHANGE_TYPE,
        N.RAW_COMMIT_TIMESTAMP,
        N.RAW_COMMIT_VERSION,
    )


def commit_history(feed: DataFrame, enabled_at: int = FEED_ENABLED_AT) -> DataFrame:
    """Commit history of a feed: one row per version; one commit switched the feed on."""
    commits = feed.groupBy(F.col(N.COMMIT_VERSION).alias("version")).agg(
        F.max(N.COMMIT_TIMESTAMP).alias("timestamp")
    )
    switch = F.col("version") == enabled_at
    return commits.select(
        "version",
        "timestamp",
        F.when(switch, "SET TBLPROPERTIES").otherwise("WRITE").alias("operation"),
        F.when(switch, F.lit('{"%s":"true"}' % N.FEED_PROPERTY)).alias("properties"),
    )


# When the feed of users is switched, on, off and on again; the last but one by unsetting the property.
SWITCHES = ((5, True), (10, False), (15, True))


def switched_history(feed: DataFrame) -> DataFrame:
    """Commit history of a feed that is off for some versions."""
    properties = F.lit(None).cast("string")
    for version, on in SWITCHES:
        text = '{"%s":"true"}' if on else '["%s"]'
        properties = F.when(F.col("version") == version, F.lit(text % N.FEED_PROPERTY)).otherwise(properties)
    return commit_history(feed).withColumn("properties", properties).withColumn(
        "operation", F.when(F.col("properties").isNull(), "WRITE").otherwise("SET TBLPROPERTIES")
    )


# --- change logs of the business tables -----------------------------------------------------------


BUSINESS_CHANGES = (
    (N.INSERT, 0, "2024-01-01 00:00:00"),
    (N.UPDATE_PREIMAGE, 2, "2024-01-03 00:00:00"),
    (N.UPDATE_POSTIMAGE, 2, "2024-01-03 00:00:00"),
)


def business_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Feed of a business table: version 0 inserts every row, version 2 touches every row again."""
    rows = source_rows(spark, sf_dir, name)
    changes = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(kind).alias("kind"),
                    F.lit(version).cast("long").alias("version"),
                    moment(at).alias("at"),
                )
                for kind, version, at in BUSINESS_CHANGES
            ]
        )
    )
    return rows.withColumn("_change", changes).select(
        *rows.columns,
        F.col("_change.kind").alias(N.CHANGE_TYPE),
        F.col("_change.version").alias(N.COMMIT_VERSION),
        F.col("_change.at").alias(N.COMMIT_TIMESTAMP),
    )


def business_history(spark: SparkSession) -> DataFrame:
    """Commits of every business table: created, feed switched on, all rows touched."""
    on = '{"%s":"true"}' % N.FEED_PROPERTY
    rows = [(0, 1, "CREATE TABLE", None), (1, 2, "SET TBLPROPERTIES", on), (2, 3, "WRITE", None)]
    return spark.createDataFrame(
        rows, "version long, day int, operation string, properties string"
    ).select(
        "version",
        F.make_timestamp(F.lit(2024), F.lit(1), "day", F.lit(0), F.lit(0), F.lit(0)).alias("timestamp"),
        "operation",
        "properties",
    )


# --- customers whose whole table is written twice ---------------------------------------------------


def overwritten_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 0 inserts all customers, version 1 deletes and inserts them again with a higher balance."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    commits = (("insert", 0, 0, LOAD_TIME), ("delete", 1, 0, RUN_TIME), ("insert", 1, 1, RUN_TIME))
    changes = [
        F.struct(
            (F.col("c_acctbal") + more).alias("c_acctbal"),
            F.lit(kind).alias(N.CHANGE_TYPE),
            F.lit(version).cast("long").alias(N.COMMIT_VERSION),
            moment(at).alias(N.COMMIT_TIMESTAMP),
        )
        for kind, version, more, at in commits
    ]
    return rows.select("c_custkey", F.inline(F.array(*changes)))


def skewed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of users, a third of it on user 1 and another third on NULL."""
    user = F.when(F.col("event_id") % 3 == 0, F.lit(1)).when(F.col("event_id") % 3 == 2, F.col("user_id"))
    return user_feed(spark, sf_dir).withColumn("user_id", user.cast("long"))
