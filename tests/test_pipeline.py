"""All layers on a few rows of every table, through two runs with changes in between."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.operators.normalize import add_run_metadata, normalize_changes
from tidemark.plans import pipeline
from tidemark.plans.gold import dim_supplier
from tidemark.plans.silver import ENTITIES
from tidemark.sources import changelog
from tidemark.streaming import history, ledger
from workloads import inputs as I
from workloads import queries as Q
from workloads.queries import configured_feeds, entity_of

SF = "/root/testdata/sf0.001"
FEW = {
    "customer": "c_custkey < 6",
    "nation": "true",
    "region": "true",
    "part": "p_partkey < 5",
    "order": "o_custkey < 6",
    "supplier": "s_suppkey < 4",
    "partsupp": "ps_partkey < 3",
}


def test_two_runs_of_all_layers(spark, folder):
    feeds = configured_feeds(f"{folder}/sources", f"{folder}/raw")
    layout = pipeline.Layout(folder)
    rows = {name: I.source_rows(spark, SF, name).where(few).coalesce(1) for name, few in FEW.items()}
    history_rows = I.business_history(spark).where("version < 2")

    def commit(feed, changed, kind, version, commits):
        changes = changed.select(
            "*",
            F.lit(kind).alias(N.CHANGE_TYPE),
            F.lit(version).cast("long").alias(N.COMMIT_VERSION),
            F.make_timestamp(F.lit(2024), F.lit(1), F.lit(version + 1), F.lit(0), F.lit(0), F.lit(0)).alias(
                N.COMMIT_TIMESTAMP
            ),
        )
        changelog.write_commits(changes, commits, feed.source_path)

    for feed in feeds:
        commit(feed, rows[entity_of(feed.table)], N.INSERT, 0, history_rows)
    loads = pipeline.run_pipeline(spark, feeds, layout)
    assert {load.kind for load in loads.values()} == {"initial"}

    def gold(name):
        return spark.read.parquet(layout.table("gold", name))

    orders = rows["order"].count()
    assert gold("dim_customer").count() == 7
    assert gold("fact_order").count() == orders > 3
    assert gold("fact_order").where("customer_surrogate_key = -1").count() == 0

    by_table = {feed.table: feed for feed in feeds}
    later = I.business_history(spark).where("version = 2")
    moved = rows["customer"].where("c_custkey = 1").withColumn("c_name", F.lit("renamed"))
    commit(by_table["h_customer"], moved, N.UPDATE_POSTIMAGE, 2, later)
    gone = rows["order"].where("o_custkey = 2")
    commit(by_table["h_order"], gone, N.DELETE, 2, later)
    loads = pipeline.run_pipeline(spark, feeds, layout)
    assert loads["h_customer"].rows == 1 and loads["h_order"].rows == gone.count()
    assert loads["h_part"] is None or loads["h_part"].rows == 0

    customers = history.read_scd2(spark, layout.table("silver", "customer"), ["c_custkey"])
    assert customers.count() == 7
    names = {r["customer_key"]: r["customer_name"] for r in gold("dim_customer").collect()}
    assert names[1] == "renamed" and len(names) == 7
    assert gold("fact_order").count() == orders - gone.count()
    counts = pipeline.layer_counts(spark, layout, feeds).collect()
    assert len(counts) == 30


def test_layers_are_the_same_whether_events_are_dealt_by_key_or_shuffled(spark, monkeypatch):
    """Two loads of every feed; all events dealt over buckets while the ledgers are written, or none."""
    found, dealt = [], []
    read = ledger.read_batches
    monkeypatch.setattr(ledger, "MOST_OPEN", 3)
    monkeypatch.setattr(history, "read_batches", lambda *given, **more: dealt.append(ledger.is_dealt(*given[:3])) or read(*given, **more))
    for least in (1, 10**9):
        monkeypatch.setattr(ledger, "BUCKET_EVENTS", least)
        monkeypatch.setattr(Q, "_STORED", {})
        layout, feeds = Q.finished_pipeline(spark, SF)
        tables = [pipeline.layer_counts(spark, layout, feeds), pipeline.read_fact(spark, layout.table("gold", "fact_order"))]
        for name, entity in ENTITIES.items():
            place = layout.table("silver", name)
            tables.append(history.read_scd1(spark, place) if entity.scd_type == 1 else history.read_scd2(spark, place, entity.keys))
        found.append([sorted(map(str, rows.collect())) for rows in tables])
    assert found[0] == found[1] and all(found[0])
    assert dealt == [True] * 9 + [False] * 9


def test_source_without_rows_leaves_the_unknown_member(spark, folder):
    layout = pipeline.Layout(folder)
    for name in ("supplier", "nation", "region"):
        entity = ENTITIES[name]
        rows = normalize_changes(
            I.source_rows(spark, SF, name).selectExpr(
                "*", "'insert' as _change_type", "0L as _commit_version", "timestamp'2024-01-01' as _commit_timestamp"
            )
        )
        bronze = add_run_metadata(rows, "MRI", I.moment(I.RUN_TIME)).where("false")
        bronze.write.parquet(layout.table("bronze", entity.source))
    empty = [pipeline.current(spark, layout, name) for name in ("supplier", "nation", "region")]
    assert [row["supplier_key"] for row in dim_supplier(*empty).collect()] == [-1]
