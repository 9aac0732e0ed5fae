"""The registered queries: each runs one capability over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.functions.calendar import date_key
from tidemark.functions.keys import business_key
from tidemark.operators import ingest, loads, normalize, scd
from tidemark.plans import gold, pipeline
from tidemark.plans.silver import ENTITIES, clean
from tidemark.session import work_folder
from tidemark.sources import changelog, feeds
from tidemark.sources.storage import move_folder
from tidemark.sources.streams import stream_path, stream_table
from tidemark.streaming import bronze, history
from tidemark.streaming.ledger import append_changes
from tidemark.streaming.triggered import finish, start
from workloads import inputs as I

Query = Callable[[SparkSession, str], DataFrame]

WINDOW_START, WINDOW_END = 5, 19
SNAPSHOT_VERSION = 14
MICRO_BATCHES = 4
# Low enough that the skewed feed has hot keys in the smallest tables too.
HOT_USER_ROWS = 100
BAD_FEED = "h_part"
SECOND_TEXT = "yyyy-MM-dd HH:mm:ss"

# The two configured source systems and their tables.
SYSTEMS = (
    {
        "source_system": "MRI",
        "tables": ("h_customer", "h_nation", "h_region", "h_part"),
    },
    {
        "source_system": "OAH",
        "tables": ("h_order", "h_supplier", "h_partsupp"),
    },
)


def configured_feeds(source_root: str, target_root: str) -> list[feeds.Feed]:
    found = []
    for system in SYSTEMS:
        name = system["source_system"]
        found += feeds.feeds_from_config(
            {
                "source_system": name,
                "source_system_path": source_root,
                "target_system_path": f"{target_root}/{name.lower()}",
                "tables": [{"table_name": table} for table in system["tables"]],
            }
        )
    return found


def entity_of(table: str) -> str:
    return table.removeprefix("h_")


# --- change feed ----------------------------------------------------------------------------------

_STORED: dict[tuple[str, str], str] = {}


def user_log(spark: SparkSession, sf_dir: str) -> changelog.ChangeLog:
    """The user feed as a change log on shared storage; written once per application."""
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _STORED:
        feed = I.user_feed_with_preimages(spark, sf_dir)
        path = work_folder(spark, "user-log")
        changelog.write_commits(feed, I.commit_history(I.user_feed(spark, sf_dir)), path)
        _STORED[place] = path
    return changelog.ChangeLog(spark, _STORED[place], I.USER_KEYS, ("event_id",))


def cdf_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_log(spark, sf_dir).changes(WINDOW_START, WINDOW_END)


def cdf_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_changes(I.user_feed_with_preimages(spark, sf_dir))


def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = I.user_feed_with_preimages(spark, sf_dir)
    return changelog.snapshot_at(feed, I.USER_KEYS, SNAPSHOT_VERSION, ("event_id",))


def snapshot_from_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same snapshot from a checkpoint of an earlier version and the changes after it."""
    path, feed = work_folder(spark, "checkpointed-log"), I.user_feed_with_preimages(spark, sf_dir)
    changelog.write_commits(feed, I.commit_history(I.user_feed(spark, sf_dir)), path)
    log = changelog.ChangeLog(spark, path, I.USER_KEYS, ("event_id",))
    for version in (2, I.FEED_ENABLED_AT + 3, SNAPSHOT_VERSION + 4):
        log.write_checkpoint(version)
    return log.snapshot(SNAPSHOT_VERSION)


def snapshot_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = changelog.snapshot_at(
        I.user_feed(spark, sf_dir), I.USER_KEYS, SNAPSHOT_VERSION, ("event_id",)
    )
    at = I.moment(I.LOAD_TIME)
    return normalize.tag_snapshot(snapshot, SNAPSHOT_VERSION, at, "MRI", I.moment(I.RUN_TIME))


def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.normalize_changes(I.user_feed(spark, sf_dir))
    tagged = normalize.add_run_metadata(rows, "MRI", I.moment(I.RUN_TIME))
    # A second pass must leave the rows as they are.
    return normalize.add_run_metadata(tagged, "OAH")


def business_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = I.table(spark, sf_dir, "lineitem").withColumn(N.SOURCE_SYSTEM, F.lit("OAH"))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        business_key(["l_partkey", "l_suppkey", N.SOURCE_SYSTEM]),
        business_key([F.col("l_orderkey"), F.col("l_linenumber")], "-", "line_key"),
        business_key([F.nullif(F.col("l_returnflag"), F.lit("N")), "l_linestatus"], "/", "flag_key"),
    )


def feed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.last_version(I.commit_history(I.user_feed(spark, sf_dir)))


def commit_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = I.commit_history(I.user_feed(spark, sf_dir))
    return changelog.commit_timestamps(history, SNAPSHOT_VERSION)


def feed_start_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.feed_start(I.commit_history(I.user_feed(spark, sf_dir)))


def feed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The times a feed was on, with the commits of each, and what the feed is now."""
    history = I.switched_history(I.user_feed(spark, sf_dir))
    intervals = changelog.feed_intervals(history)
    inside = F.col("version").between(F.col("start_version"), F.coalesce("end_version", F.lit((1 << 63) - 1)))
    counted = history.select("version").join(F.broadcast(intervals), inside).groupBy("start_version", "end_version")
    now = F.broadcast(changelog.feed_state(history))
    return counted.agg(F.count(F.lit(1)).alias("commits")).join(now, F.col("start_version") <= F.col("latest"))


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = changelog.changes_between(I.user_feed(spark, sf_dir), 0, SNAPSHOT_VERSION)
    return ingest.high_water_mark(normalize.normalize_changes(loaded))


def version_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user as a feed of its own, of which versions up to 14 were copied before."""
    version = F.col(N.COMMIT_VERSION)
    state = I.user_feed(spark, sf_dir).groupBy("user_id").agg(
        F.max(F.when(version <= SNAPSHOT_VERSION, version)).alias("processed"),
        F.max(version).alias("latest"),
    )
    window = ingest.version_window(
        F.col("processed"), F.lit(I.FEED_ENABLED_AT).cast("long"), F.col("latest")
    )
    return state.select(
        "user_id", "processed", "latest", *[value.cast("long").alias(k) for k, value in window.items()]
    )


# --- ingestion ------------------------------------------------------------------------------------


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = work_folder(spark, "raw-history")
    feed = I.user_feed_with_preimages(spark, sf_dir)
    ingest.write_history(feed, target, "MRI", I.moment(I.RUN_TIME))
    return loads.read_history(spark, target)


def raw_history_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; the second brings a column the first did not have."""
    target = work_folder(spark, "raw-history")
    feed, run = I.user_feed_with_preimages(spark, sf_dir), I.moment(I.RUN_TIME)
    early = F.col(N.COMMIT_VERSION) <= SNAPSHOT_VERSION
    ingest.write_history(feed.where(early), target, "MRI", run)
    grade = F.when(F.col("value") >= 100, "high").otherwise("low")
    ingest.write_history(feed.where(~early).withColumn("grade", grade), target, "MRI", run)
    return loads.read_history(spark, target)


def initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, target = user_log(spark, sf_dir), work_folder(spark, "initial-load")
    ingest.load_initial(log, target, I.FEED_ENABLED_AT, "MRI", I.moment(I.RUN_TIME))
    return loads.read_history(spark, target)


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run alone: what the change window adds to the first load."""
    log, target = user_log(spark, sf_dir), work_folder(spark, "incremental-load")
    ingest.load_initial(log, target, I.FEED_ENABLED_AT, "MRI", I.moment(I.RUN_TIME))
    ingest.load_incremental(log, target, I.FEED_ENABLED_AT, "MRI", I.moment(I.RUN_TIME))
    history = loads.read_history(spark, target)
    return history.where(F.col(N.RAW_COMMIT_VERSION) >= I.FEED_ENABLED_AT)


def ingest_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load, change window, and a third run that finds nothing new."""
    log, target = user_log(spark, sf_dir), work_folder(spark, "two-runs")
    for _ in range(3):
        ingest.ingest(log, target, "MRI", I.moment(I.RUN_TIME))
    return loads.read_history(spark, target)


def ingest_after_broken_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs; before each a load broke off with some of its rows written, and behind the last a move was cut short."""
    log, target = user_log(spark, sf_dir), work_folder(spark, "broken-load")
    run = I.moment(I.RUN_TIME)

    def break_off(changes: DataFrame, load: int) -> None:
        some = changes.where(F.col("event_id") % 3 == 0)
        rows = normalize.add_run_metadata(normalize.normalize_changes(some), "MRI", F.lit("2024-01-31").cast("timestamp"))
        loads.stage_load(rows, target, load)

    break_off(log.changes(0, I.FEED_ENABLED_AT), 0)
    ingest.ingest(log, target, "MRI", run)
    break_off(log.changes(I.FEED_ENABLED_AT, SNAPSHOT_VERSION), 1)
    ingest.ingest(log, target, "MRI", run)
    # The last load stands in the log, but its files are where they were written.
    move_folder(spark, f"{target}/_load=1", f"{target}/_staging/1")
    ingest.ingest(log, target, "MRI", run)
    return loads.read_history(spark, target)


def ingest_across_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that was off for some versions: first load, its first time, what changed meanwhile, its second time."""
    source, target = work_folder(spark, "gap-log"), work_folder(spark, "gap")
    feed = I.user_feed_with_preimages(spark, sf_dir)
    changelog.write_commits(feed, I.switched_history(I.user_feed(spark, sf_dir)), source)
    log = changelog.ChangeLog(spark, source, I.USER_KEYS, ("event_id",))
    while ingest.ingest(log, target, "MRI", I.moment(I.RUN_TIME), on_gap="restart") is not None:
        pass
    return loads.read_history(spark, target)


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says about a first load and a change window."""
    log, target = user_log(spark, sf_dir), work_folder(spark, "load-log")
    for _ in range(2):
        ingest.ingest(log, target, "MRI", I.moment(I.RUN_TIME))
    return loads.load_log(spark, target).select(
        "load",
        (F.col("feed") == log.path).alias("of_this_feed"),
        "source_system",
        "kind",
        "start_version",
        "end_version",
        "row_count",
    )


def write_business_logs(
    spark: SparkSession, sf_dir: str, found: list[feeds.Feed], empty: tuple[str, ...] = ()
) -> None:
    history = I.business_history(spark)

    def write(feed: feeds.Feed) -> None:
        changes = I.business_feed(spark, sf_dir, entity_of(feed.table))
        if feed.table in empty:
            changes = changes.where("false")
        # Two versions hold all rows: what a task has read goes to both.
        changelog.write_commits(changes, history, feed.source_path, gather=False)

    jobs = [lambda feed=feed: write(feed) for feed in found]
    pipeline.in_parallel(spark, jobs, pipeline.CONCURRENT_FEEDS)


def ingest_all_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_folder(spark, "all-feeds")
    found = configured_feeds(f"{root}/sources", f"{root}/raw")
    write_business_logs(spark, sf_dir, found)
    for _ in range(2):
        pipeline.ingest_all(spark, found, I.moment(I.RUN_TIME))
    counts = [
        loads.read_history(spark, feed.target_path)
        .groupBy(N.SOURCE_SYSTEM, N.RAW_CHANGE_TYPE, N.RAW_COMMIT_VERSION)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("table_name", F.lit(feed.table))
        for feed in found
    ]
    return reduce(DataFrame.unionByName, counts)


def ingest_with_bad_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feed, one of which has no source: what failed, and the rows the others have."""
    root = work_folder(spark, "bad-feed")
    found = configured_feeds(f"{root}/sources", f"{root}/raw")
    write_business_logs(spark, sf_dir, [feed for feed in found if feed.table != BAD_FEED])
    _, errors = pipeline.ingest_each(spark, found, I.moment(I.RUN_TIME))
    nothing = spark.range(0)
    counts = [
        (nothing if loads.last_finished(spark, feed.target_path) is None else loads.read_history(spark, feed.target_path))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(feed.table).alias("table_name"), F.lit(feed.table in errors).alias("failed"), "row_count")
        for feed in found
    ]
    return reduce(DataFrame.unionByName, counts)


def feed_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every configured feed with the rows its source holds."""
    found = configured_feeds("/lake/sources", "/lake/raw")
    records = [
        I.source_rows(spark, sf_dir, entity_of(feed.table))
        .agg(F.count(F.lit(1)).alias("source_rows"))
        .select(
            F.lit(feed.table).alias("table_name"),
            F.lit(feed.source_system).alias("source_system"),
            F.lit(feed.source_path).alias("source_table_path"),
            F.lit(feed.target_path).alias("target_table_path"),
            "source_rows",
        )
        for feed in found
    ]
    return reduce(DataFrame.unionByName, records)


# --- bronze and silver streams --------------------------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_folder(spark, "bronze")
    feed = I.user_feed_with_preimages(spark, sf_dir)
    ingest.write_history(feed, f"{root}/raw", "MRI", I.moment(I.RUN_TIME))
    for _ in range(2):  # the second start finds nothing new
        rows = bronze.bronze_rows(spark, f"{root}/raw")
        finish(bronze.write_bronze(rows, f"{root}/bronze", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/bronze")


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).drop(N.RAW_FILE_PATH, N.RAW_FILE_MODIFICATION_TIME)


def bronze_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bronze table read by its name after a second load that brought a column."""
    root, run = work_folder(spark, "bronze-evolved"), I.moment(I.RUN_TIME)
    table = f"brz_users_{root[-12:]}"
    feed, early = I.user_feed_with_preimages(spark, sf_dir), F.col(N.COMMIT_VERSION) <= SNAPSHOT_VERSION
    grade = F.when(F.col("value") >= 100, "high").otherwise("low")
    for changes in (feed.where(early), feed.where(~early).withColumn("grade", grade)):
        ingest.write_history(changes, f"{root}/raw", "MRI", run)
        finish(bronze.create_bronze_table(spark, table, f"{root}/raw", f"{root}/bronze", f"{root}/checkpoint"))
    rows = spark.table(table).drop(N.RAW_FILE_PATH, N.RAW_FILE_MODIFICATION_TIME)
    spark.sql(f"DROP TABLE {table}")
    return rows


def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).select(
        "event_id",
        F.col(N.RAW_FILE_PATH).endswith(".parquet").alias("has_path"),
        F.col(N.RAW_FILE_MODIFICATION_TIME).isNotNull().alias("has_time"),
    )


def _silver(name: str) -> Query:
    return lambda spark, sf_dir: I.silver_rows(spark, sf_dir, name)


def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders streamed from a bronze table in the catalog through the cleaning step."""
    root = work_folder(spark, "silver")
    table = f"stbl_order_{root[-12:]}"
    I.bronze_rows(spark, sf_dir, "order").write.parquet(f"{root}/raw")
    finish(
        bronze.create_bronze_table(
            spark, table, f"{root}/raw", f"{root}/bronze", f"{root}/checkpoints/bronze"
        )
    )
    rows = clean(stream_table(spark, table), ENTITIES["order"], I.moment(I.RUN_TIME))
    writer = rows.writeStream.format("parquet").option("path", f"{root}/silver")
    finish(start(writer, f"{root}/checkpoints/silver"))
    spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(f"{root}/silver")


# --- slowly changing dimensions -------------------------------------------------------------------


def scd1_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = I.user_changes(I.user_feed(spark, sf_dir))
    return scd.scd1_latest(changes, I.USER_KEYS, tie_break=("event_id",))


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = I.user_changes(I.user_feed(spark, sf_dir))
    return scd.scd2_history(changes, I.USER_KEYS, tie_break=("event_id",))


def snapshot_overwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.snapshot_at(I.overwritten_feed(spark, sf_dir), ("c_custkey",), 1)


def scd1_overwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = normalize.normalize_changes(I.overwritten_feed(spark, sf_dir))
    return scd.scd1_latest(changes, ("c_custkey",))


def scd2_overwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = normalize.normalize_changes(I.overwritten_feed(spark, sf_dir))
    return scd.scd2_history(changes, ("c_custkey",))


def scd2_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hot keys, one of them NULL, split off and cut into slices."""
    changes = I.user_changes(I.skewed_feed(spark, sf_dir))
    return scd.scd2_history(changes, I.USER_KEYS, tie_break=("event_id",), hot_rows=HOT_USER_ROWS)


def scd2_view_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = scd2_skewed(spark, sf_dir)
    return scd.scd2_view(versions, I.USER_KEYS, HOT_USER_ROWS).drop(N.ROW_VALID_TO)


def scd2_history_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All changes of a day at one point in time: one of them survives."""
    changes = I.user_changes(I.tied_feed(spark, sf_dir))
    return scd.scd2_history(changes, I.USER_KEYS, tie_break=("event_id",))


def scd2_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users kept by two systems under the same keys; the system is part of the key."""
    changes = normalize.normalize_changes(I.user_feed(spark, sf_dir)).withColumn(
        N.SOURCE_SYSTEM, F.when(F.col("value") >= 100, "OAH").otherwise("MRI")
    )
    keyed = changes.select(business_key(["user_id", N.SOURCE_SYSTEM]), "*")
    return scd.scd2_history(keyed, ["user_id", N.SOURCE_SYSTEM], tie_break=("event_id",))


def user_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users' type 2 table, stored once per application as the views find it."""
    place = (spark.sparkContext.applicationId, f"versions of {sf_dir}")
    if place not in _STORED:
        path = work_folder(spark, "user-versions")
        scd2_history(spark, sf_dir).write.parquet(path)
        _STORED[place] = path
    return spark.read.parquet(_STORED[place])


def scd2_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = scd.scd2_view(user_versions(spark, sf_dir), I.USER_KEYS)
    return view.withColumn(N.ROW_VALID_TO, F.date_format(N.ROW_VALID_TO, SECOND_TEXT))


def gold_scd2_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = scd.scd2_dimension(user_versions(spark, sf_dir), "user_key", ["user_id", "value"])
    return view.withColumn(N.ROW_VALID_TO, F.date_format(N.ROW_VALID_TO, SECOND_TEXT))


def _shuffled_stream(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The user changes as a stream of files that are not in time order, one per micro-batch."""
    changes = I.user_changes(I.user_feed(spark, sf_dir))
    changes.repartition(MICRO_BATCHES, "event_id").write.parquet(f"{root}/changes")
    return stream_path(spark, f"{root}/changes", max_files=1)


def scd1_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_folder(spark, "scd1")
    stream = _shuffled_stream(spark, sf_dir, root)
    finish(append_changes(stream, f"{root}/ledger", f"{root}/checkpoint"))
    history.refresh_scd1(spark, f"{root}/ledger", f"{root}/users", I.USER_KEYS, tie_break=("event_id",))
    return history.read_scd1(spark, f"{root}/users")


def scd2_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three refreshes: some days, the days after them in order, and last the days before, too late."""
    root = work_folder(spark, "scd2")
    changes = I.user_changes(I.user_feed(spark, sf_dir))
    version = F.col(N.RAW_COMMIT_VERSION)
    middle = version.between(WINDOW_START, WINDOW_END)
    for arrived in (middle, version > WINDOW_END, version < WINDOW_START):
        changes.where(arrived).write.mode("append").parquet(f"{root}/changes")
        stream = stream_path(spark, f"{root}/changes")
        finish(append_changes(stream, f"{root}/ledger", f"{root}/checkpoint"))
        history.refresh_scd2(
            spark, f"{root}/ledger", f"{root}/users", I.USER_KEYS, tie_break=("event_id",)
        )
    return history.read_scd2(spark, f"{root}/users", I.USER_KEYS)


# --- star schema ----------------------------------------------------------------------------------


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_customer(*[I.silver_rows(spark, sf_dir, t) for t in ("customer", "nation", "region")])


def dim_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_nation(*[I.silver_rows(spark, sf_dir, t) for t in ("nation", "region")])


def dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_region(I.silver_rows(spark, sf_dir, "region"))


def dim_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_supplier(*[I.silver_rows(spark, sf_dir, t) for t in ("supplier", "nation", "region")])


def dim_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_part(I.silver_rows(spark, sf_dir, "part"))


def dim_part_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_part_supplier(I.silver_rows(spark, sf_dir, "partsupp"))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar with the number of orders placed on each day."""
    placed = (
        I.silver_rows(spark, sf_dir, "order")
        .groupBy(date_key(F.col("o_orderdate")).alias("date_key"))
        .agg(F.count(F.lit(1)).alias("orders_placed"))
    )
    days = gold.dim_date(spark).join(placed, "date_key", "left")
    return days.withColumn("orders_placed", F.coalesce("orders_placed", F.lit(0)))


def fact_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_order(I.silver_rows(spark, sf_dir, "order"), dim_customer(spark, sf_dir))


def dim_customer_unlocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one nation lose it, nations of one region lose theirs."""
    customer, nation, region = (I.silver_rows(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return gold.dim_customer(
        customer.withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(3))),
        nation.withColumn("n_regionkey", F.nullif("n_regionkey", F.lit(2))),
        region,
    )


def fact_order_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders have no date; customers in debt are missing from the dimension."""
    orders = I.silver_rows(spark, sf_dir, "order")
    dated = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    customers = dim_customer(spark, sf_dir).where("customer_account_balance >= 0")
    return gold.fact_order(orders.withColumn("o_orderdate", dated), customers)


def fact_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_order_lines(fact_order(spark, sf_dir), I.table(spark, sf_dir, "lineitem"))


def fact_order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = pipeline.Layout(work_folder(spark, "fact"))
    bronze_path = layout.table("bronze", "h_order")
    I.bronze_rows(spark, sf_dir, "order").write.parquet(bronze_path)
    clean(stream_path(spark, bronze_path), ENTITIES["order"]).createOrReplaceTempView("slv_order_stream")
    orders = spark.sql("SELECT * FROM slv_order_stream")
    pipeline.refresh_fact_order(spark, orders, dim_customer(spark, sf_dir), layout)
    return pipeline.read_fact(spark, layout.table("gold", "fact_order"))


def finished_pipeline(spark: SparkSession, sf_dir: str) -> tuple[pipeline.Layout, list[feeds.Feed]]:
    """All layers after a first load and one change window of every feed; run once per application."""
    place = (spark.sparkContext.applicationId, f"pipeline of {sf_dir}")
    root = _STORED.get(place) or work_folder(spark, "pipeline")
    found, layout = configured_feeds(f"{root}/sources", f"{root}/raw"), pipeline.Layout(root)
    if place not in _STORED:
        write_business_logs(spark, sf_dir, found)
        pipeline.ingest_all(spark, found, I.moment(I.RUN_TIME))
        pipeline.run_pipeline(spark, found, layout, I.moment(I.RUN_TIME))
        _STORED[place] = root
    return layout, found


def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.layer_counts(spark, *finished_pipeline(spark, sf_dir))


def pipeline_fact_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact the pipeline published: created by the first load, updated by the change window."""
    layout, _ = finished_pipeline(spark, sf_dir)
    return pipeline.read_fact(spark, layout.table("gold", "fact_order"))


def pipeline_customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both versions of every customer in the silver table of the pipeline."""
    layout, _ = finished_pipeline(spark, sf_dir)
    entity = ENTITIES["customer"]
    return history.read_scd2(spark, layout.table("silver", entity.name), entity.keys).drop("_batch_id")


def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the bronze streams of the pipeline observed of their micro-batches."""
    layout, _ = finished_pipeline(spark, sf_dir)
    log = spark.read.parquet(layout.stream_log("bronze"))
    return log.groupBy("stream").agg(F.sum("row_count").alias("row_count"), F.max("high_version").alias("high_version"))


def pipeline_empty_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers where two sources, suppliers and orders, never had a row."""
    root = work_folder(spark, "pipeline-empty")
    found = configured_feeds(f"{root}/sources", f"{root}/raw")
    write_business_logs(spark, sf_dir, found, empty=("h_supplier", "h_order"))
    layout = pipeline.Layout(root)
    pipeline.run_pipeline(spark, found, layout, I.moment(I.RUN_TIME))
    return pipeline.layer_counts(spark, layout, found)


QUERIES: dict[str, Query] = {
    "cdf_range": cdf_range,
    "cdf_normalized": cdf_normalized,
    "snapshot_as_of": snapshot_as_of,
    "snapshot_from_checkpoint": snapshot_from_checkpoint,
    "snapshot_tagged": snapshot_tagged,
    "run_metadata": run_metadata,
    "business_keys": business_keys,
    "feed_versions": feed_versions,
    "commit_timestamps": commit_timestamps,
    "feed_start_version": feed_start_version,
    "feed_state": feed_state,
    "high_water_mark": high_water_mark,
    "version_windows": version_windows,
    "raw_history": raw_history,
    "raw_history_evolved": raw_history_evolved,
    "initial_load": initial_load,
    "incremental_load": incremental_load,
    "ingest_two_runs": ingest_two_runs,
    "ingest_after_broken_load": ingest_after_broken_load,
    "ingest_across_gap": ingest_across_gap,
    "load_log": load_log,
    "ingest_all_feeds": ingest_all_feeds,
    "ingest_with_bad_feed": ingest_with_bad_feed,
    "feed_configs": feed_configs,
    "bronze_stream": bronze_stream,
    "bronze_evolved": bronze_evolved,
    "bronze_lineage": bronze_lineage,
    **{f"silver_{name}": _silver(name) for name in ENTITIES},
    "silver_stream": silver_stream,
    "scd1_latest": scd1_latest,
    "snapshot_overwritten": snapshot_overwritten,
    "scd1_overwritten": scd1_overwritten,
    "scd2_overwritten": scd2_overwritten,
    "scd2_skewed": scd2_skewed,
    "scd2_view_skewed": scd2_view_skewed,
    "scd2_history": scd2_history,
    "scd2_history_tied": scd2_history_tied,
    "scd2_two_sources": scd2_two_sources,
    "scd2_view": scd2_view,
    "gold_scd2_dim": gold_scd2_dim,
    "scd1_stream": scd1_stream,
    "scd2_stream": scd2_stream,
    "dim_customer": dim_customer,
    "dim_customer_unlocated": dim_customer_unlocated,
    "dim_nation": dim_nation,
    "dim_region": dim_region,
    "dim_supplier": dim_supplier,
    "dim_part": dim_part,
    "dim_part_supplier": dim_part_supplier,
    "dim_date": dim_date,
    "fact_order": fact_order,
    "fact_order_gaps": fact_order_gaps,
    "fact_order_lines": fact_order_lines,
    "fact_order_stream": fact_order_stream,
    "pipeline_end_to_end": pipeline_end_to_end,
    "pipeline_fact_order": pipeline_fact_order,
    "pipeline_customer_versions": pipeline_customer_versions,
    "stream_log": stream_log,
    "pipeline_empty_source": pipeline_empty_source,
}
