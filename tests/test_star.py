from __future__ import annotations

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import number_key
from tidemark.plans import gold, pipeline
from tidemark.plans.silver import ENTITIES, clean
from tidemark.sources.streams import stream_path
from tidemark.streaming import history
from tidemark.streaming.ledger import append_changes
from tidemark.streaming.triggered import finish
from workloads import inputs as I

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def silver(spark):
    return {name: I.silver_rows(spark, SF, name) for name in ENTITIES}


def test_silver_schemas(silver):
    assert dict(silver["order"].dtypes)["o_orderdate"] == "date"
    assert dict(silver["part"].dtypes)["p_retailprice"] == "decimal(15,2)"
    assert silver["partsupp"].where("business_key != concat_ws('|', ps_partkey, ps_suppkey, 'OAH')").count() == 0
    assert silver["customer_narrow"].columns[:3] == ["business_key", "c_custkey", "c_name"]


def test_order_status_is_one_character(spark):
    rows = I.bronze_rows(spark, SF, "order").withColumn("o_orderstatus", F.lit("Open"))
    assert {r[0] for r in clean(rows, ENTITIES["order"]).select("o_orderstatus").distinct().collect()} == {"O"}


def test_customer_without_nation_keeps_its_row(silver):
    customers = silver["customer"].withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(3)))
    dim = gold.dim_customer(customers, silver["nation"], silver["region"])
    homeless = dim.where("nation_key is null")
    expected = silver["customer"].where("c_nationkey = 3").count()
    assert homeless.count() == expected > 0
    # Missing parts drop out of the hashed text.
    assert homeless.where("customer_surrogate_key != xxhash64(cast(customer_key as string))").count() == 0


def test_nation_without_region(silver):
    nations = silver["nation"].withColumn("n_regionkey", F.nullif("n_regionkey", F.lit(2)))
    dim = gold.dim_customer(silver["customer"], nations, silver["region"])
    assert dim.count() == silver["customer"].count() + 1
    assert dim.where("region_key is null and nation_key is null").count() == 0
    assert gold.dim_nation(nations, silver["region"]).where("region_name is null").count() == 5


def test_date_dimension(spark):
    days = {r["date_key"]: r for r in gold.dim_date(spark).collect()}
    assert len(days) == 11_324
    leap = days[20240229]
    assert (leap["day_name"], leap["day_of_week"], leap["day_of_year"]) == ("Thursday", 5, 60)
    assert days[20240302]["is_weekend"] and not leap["is_weekend"] and not leap["is_holiday"]
    assert (days[-1]["full_date"], days[-1]["year"], days[-1]["month_name"]) == (dt.date(1900, 1, 1), 1900, "Unknown")


def test_orders_without_customer_or_date(silver):
    known = silver["customer"].where("c_custkey % 10 != 0")
    dim = gold.dim_customer(known, silver["nation"], silver["region"])
    orders = silver["order"].withColumn("o_orderdate", F.expr("if(o_orderkey % 97 = 0, null, o_orderdate)"))
    fact = gold.fact_order(orders, dim)
    assert [f"{n}:{t}" for n, t in fact.dtypes] == [f"{n}:{t}" for n, t in gold.FACT_SCHEMA.items()]
    assert fact.count() == orders.count()
    orphans = silver["order"].where("o_custkey % 10 = 0").count()
    assert fact.where("customer_surrogate_key = -1").count() == orphans > 0
    assert fact.where("order_date_key is null").count() == orders.where("o_orderdate is null").count() > 0


def test_order_without_lines_has_zero_totals(spark, silver):
    dim = gold.dim_customer(silver["customer"], silver["nation"], silver["region"])
    lines = I.table(spark, SF, "lineitem").where("l_orderkey % 2 = 0")
    rows = gold.fact_order_lines(gold.fact_order(silver["order"], dim), lines)
    bare = rows.where("order_key % 2 = 1")
    assert bare.count() > 0
    assert bare.where("line_item_count != 0 or total_quantity != 0 or total_extended_price != 0").count() == 0


def test_fact_stream_keeps_the_key_an_order_got(spark, folder, silver):
    """Orders come before their customer; a later change of one order picks the new key up."""
    layout = pipeline.Layout(folder)
    source = layout.table("bronze", "h_order")
    bronze = I.bronze_rows(spark, SF, "order").where("o_orderkey < 4").coalesce(1)
    bronze.write.parquet(source)

    def refresh(customers):
        orders = clean(stream_path(spark, source), ENTITIES["order"])
        dim = gold.dim_customer(customers, silver["nation"], silver["region"])
        pipeline.refresh_fact_order(spark, orders, dim, layout)
        fact = spark.read.parquet(layout.table("gold", "fact_order"))
        return {r["order_key"]: r["customer_surrogate_key"] for r in fact.collect()}

    assert set(refresh(silver["customer"].limit(0)).values()) == {-1}
    later = bronze.where("o_orderkey = 1").withColumn("_raw_change_type", F.lit("update")).withColumn(
        "_raw_commit_timestamp", F.col("_raw_commit_timestamp") + F.expr("interval 1 day")
    )
    later.write.mode("append").parquet(source)
    keys = refresh(silver["customer"])
    assert keys[1] != -1 and {keys[0], keys[2], keys[3]} == {-1}


def test_only_changed_days_of_the_fact_are_rewritten(spark, folder, silver, monkeypatch):
    layout = pipeline.Layout(folder)
    source, path = layout.table("bronze", "h_order"), layout.table("gold", "fact_order")
    day = F.when(F.col("o_orderkey") < 2, F.lit("1995-01-01")).when(F.col("o_orderkey") == 2, F.lit("1995-01-02"))
    bronze = I.bronze_rows(spark, SF, "order").where("o_orderkey < 5").withColumn("o_orderdate", day)
    bronze = bronze.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).coalesce(1)
    dim = gold.dim_customer(silver["customer"], silver["nation"], silver["region"])

    def refresh():
        orders = clean(stream_path(spark, source), ENTITIES["order"])
        pipeline.refresh_fact_order(spark, orders, dim, layout)
        rows = spark.read.parquet(path).select("order_key", "order_date_key", "order_status").collect()
        files = {f.parent.name: f.name for f in sorted(Path(path).glob("*/*.parquet"))}
        return {r["order_key"]: (r["order_date_key"], r["order_status"]) for r in rows}, files

    def change(number, hours, kind="update", **columns):
        changed = bronze.where(f"o_orderkey = {number}").withColumns(columns)
        at = F.col("_raw_commit_timestamp") + F.expr(f"interval {hours} hours")
        changed.withColumns({"_raw_change_type": F.lit(kind), "_raw_commit_timestamp": at}).write.mode(
            "append"
        ).parquet(source)

    bronze.write.parquet(source)
    rows, first = refresh()
    assert [rows[k][0] for k in range(5)] == [19950101, 19950101, 19950102, None, None]
    assert refresh()[1] == first

    change(2, 1, o_orderdate=F.lit("1995-01-03").cast("timestamp_ntz"))
    change(4, 1, kind="delete")
    rows, second = refresh()
    assert sorted(rows) == [0, 1, 2, 3] and rows[2][0] == 19950103
    assert second["order_date_key=19950101"] == first["order_date_key=19950101"]
    assert "order_date_key=19950102" not in second

    change(3, 2, kind="delete")
    with monkeypatch.context() as broken:
        def stop(*_):
            raise RuntimeError("lost")

        broken.setattr(pipeline, "write_fact", stop)
        with pytest.raises(RuntimeError):
            refresh()
    rows, third = refresh()
    assert sorted(rows) == [0, 1, 2]
    assert set(third) == {"order_date_key=19950101", "order_date_key=19950103"}

    change(0, 3, o_orderstatus=F.lit("Z"))
    rows, _ = refresh()
    assert rows[0] == (19950101, "Z") and sorted(rows) == [0, 1, 2]


def test_fact_directories_are_days(spark, folder, silver):
    dim = gold.dim_customer(silver["customer"], silver["nation"], silver["region"])
    fact = gold.fact_order(silver["order"].where("o_orderdate < '1995-02-01'"), dim)
    pipeline.write_fact(fact, f"{folder}/fact")
    stored = spark.read.parquet(f"{folder}/fact")
    one_day = stored.where("order_date_key = 19950110")
    assert stored.count() == fact.count()
    assert "PartitionFilters: [isnotnull(order_date_key" in one_day._jdf.queryExecution().toString()


def test_fact_and_order_table_keep_the_same_row_of_a_tie(spark, folder, silver):
    """Both see the same events in one moment, the fact with a customer key that silver does not know."""
    layout = pipeline.Layout(folder)
    bronze = I.bronze_rows(spark, SF, "order").where("o_orderkey < 40").coalesce(1)
    kinds = F.explode(F.array(F.lit("insert"), F.lit("update"), F.lit("delete"))).alias("kind")
    tied = bronze.select("*", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("n")).select("*", kinds)
    tied = tied.where("kind <> 'delete' or o_orderkey % 3 = 0").withColumns(
        {
            "o_comment": F.concat("o_comment", F.lit("-"), F.xxhash64("o_orderkey", "n").cast("string")),
            "o_custkey": F.col("o_custkey") + F.col("n"),
            "_raw_change_type": F.col("kind"),
        }
    )
    tied.drop("n", "kind").write.parquet(layout.table("bronze", "h_order"))
    rows = clean(stream_path(spark, layout.table("bronze", "h_order")), ENTITIES["order"])
    events, table = f"{folder}/order-events", f"{folder}/order"
    finish(append_changes(rows, events, f"{folder}/order-checkpoint"))
    history.refresh_scd1(spark, events, table, ["o_orderkey"])
    dim = gold.dim_customer(silver["customer"], silver["nation"], silver["region"])
    pipeline.refresh_fact_order(spark, rows, dim, layout)
    kept = {(r["o_orderkey"], r["o_comment"]) for r in history.read_scd1(spark, table).collect()}
    fact = spark.read.parquet(layout.table("gold", "fact_order"))
    assert {(r["order_key"], r["order_comment"]) for r in fact.collect()} == kept
    assert len(kept) == 40


def test_order_keys_beyond_int_and_row_times(spark, folder, silver):
    """The first creation of an order stays, its update moves; keys are as wide as the source's."""
    layout = pipeline.Layout(folder)
    source = layout.table("bronze", "h_order")
    wide = {"o_orderkey": F.lit(3_000_000_000), "o_custkey": F.lit(3_000_000_001)}
    bronze = I.bronze_rows(spark, SF, "order").where("o_orderkey < 1").withColumns(wide).coalesce(1)
    customer = silver["customer"].where("c_custkey = 1").withColumn("c_custkey", F.lit(3_000_000_001))
    dim = gold.dim_customer(customer, silver["nation"], silver["region"])
    for day in (1, 3, 2):
        at = F.lit(f"2024-05-0{day} 00:00:00").cast("timestamp")
        bronze.withColumns({"_raw_commit_timestamp": at, "o_comment": F.lit(f"day {day}")}).write.mode("append").parquet(source)
        orders = clean(stream_path(spark, source), ENTITIES["order"])
        pipeline.refresh_fact_order(spark, orders, dim, layout)
    (row,) = pipeline.read_fact(spark, layout.table("gold", "fact_order")).collect()
    assert (row["order_key"], row["order_comment"]) == (3_000_000_000, "day 3")
    assert row["customer_surrogate_key"] != -1
    assert (row["created_at"], row["updated_at"]) == (dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 3))


def test_keys_hash_alike_in_every_width(spark):
    rows = spark.createDataFrame([(5,), (-7,), (None,), (3_000_000_000,)], "k bigint")
    hashed = rows.select(number_key("k").alias("h"), F.xxhash64("k").alias("wide"), F.expr("xxhash64(try_cast(k as int))").alias("narrow"))
    found = [tuple(r) for r in hashed.collect()]
    assert [h == narrow for h, _, narrow in found] == [True, True, True, False]
    assert found[3][0] == found[3][1]


def test_publication_reads_only_changed_days(spark, folder, silver, monkeypatch):
    layout = pipeline.Layout(folder)
    source, path = layout.table("bronze", "h_order"), layout.table("gold", "fact_order")
    day = F.expr("cast(date_add(date'1995-01-01', cast(o_orderkey % 10 as int)) as timestamp_ntz)")
    bronze = I.bronze_rows(spark, SF, "order").where("o_orderkey < 60").withColumn("o_orderdate", day).coalesce(1)
    dim = gold.dim_customer(silver["customer"], silver["nation"], silver["region"])
    read = []
    real = pipeline.changed_days

    def seen(*args):
        facts = real(*args)
        read.append((facts._jdf.queryExecution().executedPlan().toString(), facts.inputFiles()))
        return facts

    monkeypatch.setattr(pipeline, "changed_days", seen)
    bronze.write.parquet(source)
    pipeline.refresh_fact_order(spark, clean(stream_path(spark, source), ENTITIES["order"]), dim, layout)
    assert read == []
    later = bronze.where("o_orderkey in (3, 13)").withColumn(
        "_raw_commit_timestamp", F.col("_raw_commit_timestamp") + F.expr("interval 1 day")
    )
    later.withColumn("o_orderstatus", F.lit("Z")).write.mode("append").parquet(source)
    pipeline.refresh_fact_order(spark, clean(stream_path(spark, source), ENTITIES["order"]), dim, layout)
    ((plan, files),) = read
    assert re.search(r"PartitionFilters: \[[^\]]*order_date_key#\d+ = 19950104[^\]]*\]", plan)
    assert {f.split("_refresh=")[1].split("/")[0] for f in files if "_refresh=" in f} == {"2"}
    fact = pipeline.read_fact(spark, path)
    assert fact.count() == 60 and fact.where("order_status = 'Z'").count() == 2


def test_a_day_lost_in_a_broken_publication_comes_from_the_state(spark, folder, silver, monkeypatch):
    layout = pipeline.Layout(folder)
    source, path = layout.table("bronze", "h_order"), layout.table("gold", "fact_order")
    day = F.expr("cast(date_add(date'1995-01-01', cast(o_orderkey % 3 as int)) as timestamp_ntz)")
    bronze = I.bronze_rows(spark, SF, "order").where("o_orderkey < 30").withColumn("o_orderdate", day).coalesce(1)
    dim = gold.dim_customer(silver["customer"], silver["nation"], silver["region"])

    def refresh():
        pipeline.refresh_fact_order(spark, clean(stream_path(spark, source), ENTITIES["order"]), dim, layout)

    bronze.write.parquet(source)
    refresh()
    bronze.where("o_orderkey = 3").withColumn(
        "_raw_commit_timestamp", F.col("_raw_commit_timestamp") + F.expr("interval 1 day")
    ).write.mode("append").parquet(source)
    with monkeypatch.context() as broken:
        def lose(facts, place):
            pipeline.delete_folder(spark, f"{place}/order_date_key=19950101")
            raise RuntimeError("lost")

        broken.setattr(pipeline, "write_fact", lose)
        with pytest.raises(RuntimeError):
            refresh()
    assert pipeline.read_fact(spark, path).count() == 20
    refresh()
    assert pipeline.read_fact(spark, path).count() == 30
