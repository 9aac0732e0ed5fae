"""The layers run one after the other: ingest, bronze, silver, gold."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.operators.ingest import Load, ingest
from tidemark.operators.loads import read_history
from tidemark.operators.scd import scd2_view, tie_of
from tidemark.plans import gold
from tidemark.plans.silver import ENTITIES, Entity, clean
from tidemark.sources.changelog import ChangeLog
from tidemark.sources.feeds import BRONZE_PREFIX, SOURCE_PREFIX, Feed
from tidemark.sources.storage import FILES, delete_folder, make_folder, path_exists
from tidemark.sources.streams import stream_table
from tidemark.streaming import history
from tidemark.streaming.bronze import create_bronze_table
from tidemark.streaming.ledger import append_changes, buckets_for
from tidemark.streaming.triggered import batch_log, finish

logger = logging.getLogger(__name__)

CONCURRENT_FEEDS = 3
DAY = "order_date_key"
ORDER = ["order_key"]
_CHANGED = "_changed_day"
_TIE = "_order_tie"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
RAW_COLUMNS = (N.RAW_CHANGE_TYPE, N.RAW_COMMIT_TIMESTAMP, N.RAW_COMMIT_VERSION)


@dataclass(frozen=True)
class Layout:
    """Where the layers keep their tables, all under one shared root.

    Bronze tables go by name, in a database of the catalog that belongs to this root unless another one is given.
    """

    root: str
    database: str | None = None

    def raw(self, system: str) -> str:
        return f"{self.root}/raw/{system.lower()}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def schema(self) -> str:
        """The database of the bronze tables."""
        return self.database or f"lake_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}"

    def bronze(self, name: str) -> str:
        return f"{self.schema()}.{BRONZE_PREFIX}{name.removeprefix(SOURCE_PREFIX)}"

    def stream_log(self, layer: str) -> str:
        return f"{self.root}/logs/{layer}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.root}/checkpoints/{layer}/{name}"


def in_parallel(spark: SparkSession, jobs: Sequence[Callable[[], object]], limit: int) -> list:
    """Run driver functions that submit Spark jobs, ``limit`` at a time; the first failure is raised."""
    with ThreadPoolExecutor(limit) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in running]


def keys_of(table: str) -> tuple[str, ...]:
    """Primary key of a source table, as its silver entity declares it."""
    return next(entity.keys for entity in ENTITIES.values() if entity.source == table)


def ingest_all(
    spark: SparkSession,
    feeds: Sequence[Feed],
    run_time: Column | None = None,
    limit: int = CONCURRENT_FEEDS,
) -> dict[str, Load | None]:
    """Run every feed once, ``limit`` at a time; where some fail, ``FeedsFailed`` after all others have run."""
    loads, errors = ingest_each(spark, feeds, run_time, limit)
    if errors:
        raise FeedsFailed(loads, errors)
    return loads


def ingest_each(
    spark: SparkSession,
    feeds: Sequence[Feed],
    run_time: Column | None = None,
    limit: int = CONCURRENT_FEEDS,
) -> tuple[dict[str, Load | None], dict[str, Exception]]:
    """Run every feed once and return the loads, and the errors of the feeds that failed, by table.

    The jobs of a feed go to a scheduler pool of its own, so that with ``spark.scheduler.mode`` FAIR a large feed
    does not hold up the small ones. A failed load leaves no trace in its history, and none in the others'.
    """

    def run(feed: Feed) -> Load | Exception | None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", feed.table)
        try:
            log = ChangeLog(spark, feed.source_path, keys_of(feed.table))
            return ingest(log, feed.target_path, feed.source_system, run_time)
        except Exception as error:  # reported by table, whatever it is
            logger.exception("feed %s failed", feed.table)
            return error
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    done = in_parallel(spark, [lambda feed=feed: run(feed) for feed in feeds], limit)
    outcomes = {feed.table: outcome for feed, outcome in zip(feeds, done)}
    errors = {table: outcome for table, outcome in outcomes.items() if isinstance(outcome, Exception)}
    return {table: outcome for table, outcome in outcomes.items() if table not in errors}, errors


class FeedsFailed(ExceptionGroup):
    """Some feeds failed; ``loads`` holds what the others brought, ``errors`` what went wrong, both by table."""

    def __new__(cls, loads: dict[str, Load | None], errors: dict[str, Exception]):
        self = super().__new__(cls, f"feeds failed: {', '.join(sorted(errors))}", list(errors.values()))
        self.loads, self.errors = loads, errors
        return self

    def __init__(self, loads: dict[str, Load | None], errors: dict[str, Exception]):
        super().__init__(self.message, self.exceptions)


def refresh_bronze(
    spark: SparkSession, feeds: Sequence[Feed], layout: Layout, limit: int = CONCURRENT_FEEDS
) -> dict[str, int]:
    """Copy new raw history of every feed to its bronze table, which takes up columns that are new; the rows by table.

    What every micro-batch brought is kept in the layer's log. The tables are entered into the catalog of this session under their names.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layout.schema()} LOCATION '{layout.table('catalog', 'bronze')}'")

    def run(feed: Feed) -> int:
        target = layout.table("bronze", feed.table)
        checkpoint = layout.checkpoint("bronze", feed.table)
        query = create_bronze_table(spark, layout.bronze(feed.table), feed.target_path, target, checkpoint)
        rows = finish(query)
        # One folder per stream: streams that end at the same time do not write to the same one.
        log = batch_log(spark, query, feed.table).drop("stream").coalesce(1)
        log.write.mode("append").parquet(f"{layout.stream_log('bronze')}/stream={feed.table}")
        return rows

    copied = in_parallel(spark, [lambda feed=feed: run(feed) for feed in feeds], limit)
    return {feed.table: rows for feed, rows in zip(feeds, copied)}


def refresh_silver(
    spark: SparkSession,
    layout: Layout,
    entities: Iterable[Entity] = tuple(ENTITIES.values()),
    silver_time: Column | None = None,
    limit: int = CONCURRENT_FEEDS,
    new_rows: Mapping[str, int] | None = None,
) -> None:
    """Clean new bronze rows of every entity and apply them to its type 1 or type 2 table.

    The table is created first, so that its readers find it whether or not there ever was a row. ``new_rows`` tells how
    many bronze rows there are for each source, as far as that is known, so that many are dealt by key while the ledger is
    written and not shuffled by the refresh.
    """
    new_rows = new_rows or {}

    def run(entity: Entity) -> None:
        events = layout.table("ledger", entity.name)
        target = layout.table("silver", entity.name)
        rows = clean(stream_table(spark, layout.bronze(entity.source)), entity, silver_time)
        create = history.create_scd1 if entity.scd_type == 1 else history.create_scd2
        create(spark, target, rows.schema, entity.keys)
        buckets = buckets_for(spark, new_rows.get(entity.source, 0))
        finish(append_changes(rows, events, layout.checkpoint("silver", entity.name), None, entity.keys, buckets))
        refresh = history.refresh_scd1 if entity.scd_type == 1 else history.refresh_scd2
        refresh(spark, events, target, entity.keys)
        if entity.presented:
            view = scd2_view(history.read_scd2(spark, target, entity.keys), entity.keys)
            view.write.mode("overwrite").options(**FILES).parquet(layout.table("silver", f"{entity.name}_scd2"))

    in_parallel(spark, [lambda entity=entity: run(entity) for entity in entities], limit)


def current(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """Current rows of a silver entity; none, but all columns, where its source never had a row."""
    table = layout.table("silver", name)
    if history.is_created(spark, table):
        return history.read_current(spark, table)
    # Bronze that was filled elsewhere and never refreshed into silver.
    entity = ENTITIES[name]
    bronze = spark.read.option("mergeSchema", "true").parquet(layout.table("bronze", entity.source))
    return clean(bronze, entity).limit(0)


def refresh_gold(
    spark: SparkSession, layout: Layout, limit: int = CONCURRENT_FEEDS, new_rows: Mapping[str, int] | None = None
) -> None:
    """Rewrite the dimensions from the current rows, then bring the order fact up to date; ``new_rows`` as for silver."""

    def of(name: str) -> DataFrame:
        return current(spark, layout, name)

    dimensions = {
        "dim_customer": lambda: gold.dim_customer(of("customer"), of("nation"), of("region")),
        "dim_nation": lambda: gold.dim_nation(of("nation"), of("region")),
        "dim_region": lambda: gold.dim_region(of("region")),
        "dim_supplier": lambda: gold.dim_supplier(of("supplier"), of("nation"), of("region")),
        "dim_part": lambda: gold.dim_part(of("part")),
        "dim_part_supplier": lambda: gold.dim_part_supplier(of("partsupp")),
        "dim_date": lambda: gold.dim_date(spark),
    }

    def write(name: str) -> None:
        rows = dimensions[name]()
        rows.write.mode("overwrite").options(**FILES).parquet(layout.table("gold", name))

    in_parallel(spark, [lambda name=name: write(name) for name in dimensions], limit)

    source = ENTITIES["order"].source
    orders = clean(stream_table(spark, layout.bronze(source)), ENTITIES["order"])
    customers = spark.read.parquet(layout.table("gold", "dim_customer"))
    refresh_fact_order(spark, orders, customers, layout, buckets_for(spark, (new_rows or {}).get(source, 0)))


def refresh_fact_order(
    spark: SparkSession, orders: DataFrame, customers: DataFrame, layout: Layout, buckets: int = 0
) -> None:
    """Join a stream of cleaned orders to the customer dimension and upsert the result by order.

    An order keeps the customer key it got when it last changed; a customer that comes later does not
    restate it. Of events at one point in time the one counts that silver keeps too.
    """
    tied = orders.withColumn(_TIE, tie_of(orders))
    facts = gold.fact_order(tied, customers, *RAW_COLUMNS, _TIE)
    events, state = layout.table("ledger", "fact_order"), layout.table("state", "fact_order")
    history.create_scd1(spark, state, facts.schema, ORDER)
    make_folder(spark, layout.table("gold", "fact_order"))
    finish(append_changes(facts, events, layout.checkpoint("gold", "fact_order"), None, ORDER, buckets))
    history.refresh_scd1(spark, events, state, ORDER, tie_break=[_TIE], least=["created_at"])
    publish_fact(spark, state, layout.table("gold", "fact_order"))


def publish_fact(spark: SparkSession, state: str, path: str) -> None:
    """Bring the published fact in line with its state, reading and rewriting only the days that changed.

    A changed day is what is published of it, without the orders the last refresh touched, and these orders as they are
    now. After a publication that broke off, which may have lost a day, the days come from the state instead. All days are
    written anew the first time and after a refresh that was never published. Days that have no orders any more lose
    their folder. ``<state>/publishing`` notes what has begun, ``<state>/published`` the last refresh that is out.
    """
    log, begun = f"{state}/published", f"{state}/publishing"
    now, published = history.refresh_count(spark, state), 0
    if path_exists(spark, log):
        published = spark.read.schema("refresh long").parquet(log).agg(F.max("refresh")).first()[0]
    if now == published:
        return
    if published and published == now - 1:
        days = history.changed_rows(spark, state, ORDER).select(DAY)
    else:
        days = history.read_scd1(spark, state).select(DAY)
        if path_exists(spark, path):
            days = days.union(read_fact(spark, path).select(DAY))
    days.distinct().write.mode("overwrite").parquet(f"{state}/days")
    changed = spark.read.schema(f"{DAY} int").parquet(f"{state}/days")
    if published and published == now - 1 and not path_exists(spark, f"{begun}/{now}"):
        facts = changed_days(spark, state, path, [row[DAY] for row in changed.collect()])
    else:
        same = F.col(DAY).eqNullSafe(F.col(_CHANGED))
        facts = history.read_scd1(spark, state).join(changed.withColumnRenamed(DAY, _CHANGED), same, "left_semi")
    left = facts.select(F.col(DAY).alias(_CHANGED)).distinct()
    emptied = changed.join(left, F.col(DAY).eqNullSafe(F.col(_CHANGED)), "left_anti").collect()
    make_folder(spark, f"{begun}/{now}")
    write_fact(facts, path)
    for row in emptied:
        day = row[DAY]
        delete_folder(spark, f"{path}/{DAY}={NO_DAY if day is None else day}")
    done = spark.range(0, 1, 1, 1).select(F.lit(now).cast("long").alias("refresh"))
    done.write.mode("append").parquet(log)
    delete_folder(spark, begun)


def changed_days(spark: SparkSession, state: str, path: str, days: list[int | None]) -> DataFrame:
    """These days as they have to be; of the published fact only their folders are read."""
    chosen = F.col(DAY).isin([day for day in days if day is not None])
    if None in days:
        chosen = chosen | F.col(DAY).isNull()
    touched = history.touched_keys(spark, state, ORDER)
    kept = read_fact(spark, path).where(chosen).join(touched, ORDER, "left_anti")
    typed = [F.col(name).cast(kind).alias(name) for name, kind in gold.FACT_SCHEMA.items()]
    return kept.unionByName(history.touched_rows(spark, state, ORDER).select(*typed))


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The published fact under its declared columns; a folder without orders has no rows."""
    columns = ", ".join(f"{name} {kind}" for name, kind in gold.FACT_SCHEMA.items())
    return spark.read.schema(columns).parquet(path).select(*gold.FACT_SCHEMA)


def write_fact(facts: DataFrame, path: str) -> None:
    """Write the declared columns, one directory per order day; days without rows here stay as they are.

    Adaptive execution gives every task whole days of bounded size and splits a day that holds many orders.
    """
    typed = [F.col(name).cast(kind).alias(name) for name, kind in gold.FACT_SCHEMA.items()]
    (
        facts.select(*typed)
        .hint("rebalance", DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**FILES)
        .partitionBy(DAY)
        .parquet(path)
    )


def run_pipeline(
    spark: SparkSession,
    feeds: Sequence[Feed],
    layout: Layout,
    run_time: Column | None = None,
    limit: int = CONCURRENT_FEEDS,
) -> dict[str, Load | None]:
    """One triggered refresh of everything; returns what was ingested."""
    loads = ingest_all(spark, feeds, run_time, limit)
    new_rows = refresh_bronze(spark, feeds, layout, limit)
    refresh_silver(spark, layout, silver_time=run_time, limit=limit, new_rows=new_rows)
    refresh_gold(spark, layout, limit, new_rows)
    return loads


def layer_counts(spark: SparkSession, layout: Layout, feeds: Sequence[Feed]) -> DataFrame:
    """Rows of every table of every layer."""
    tables = [("raw", feed.table, read_history(spark, feed.target_path)) for feed in feeds]
    tables += [("bronze", feed.table, spark.table(layout.bronze(feed.table))) for feed in feeds]
    for name, entity in ENTITIES.items():
        place = layout.table("silver", name)
        kept = history.read_scd1(spark, place)
        if entity.scd_type == 2:
            kept = history.read_scd2(spark, place, entity.keys)
        tables.append(("silver", name, kept))
    names = ["dim_customer", "dim_nation", "dim_region", "dim_supplier", "dim_part"]
    names += ["dim_part_supplier", "dim_date"]
    tables += [("gold", name, spark.read.parquet(layout.table("gold", name))) for name in names]
    tables.append(("gold", "fact_order", read_fact(spark, layout.table("gold", "fact_order"))))
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for layer, name, rows in tables
    ]
    total = counts[0]
    for more in counts[1:]:
        total = total.unionByName(more)
    return total
