"""What the physical plans must look like for large tables."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tests import feeds
from tidemark.operators import normalize, scd
from tidemark.plans import gold
from workloads import inputs as I
from workloads import queries as Q

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(frame):
    return len(re.findall(r"Exchange hashpartitioning", plan(frame)))


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_history_takes_one_shuffle(spark):
    changes = I.user_changes(I.user_feed(spark, SF))
    versions = scd.scd2_history(changes, ["user_id"], tie_break=("event_id",), hot_rows=None)
    assert shuffles(versions) == 1


def test_history_does_not_shuffle_what_the_order_adds(spark):
    """The hash that decides ties is made behind the shuffle, where rows are sorted."""
    changes = I.user_changes(I.user_feed(spark, SF))
    text = plan(scd.scd2_history(changes, ["user_id"], hot_rows=None))
    assert "xxhash64" in text and "xxhash64" not in text[text.index("Exchange hashpartitioning"):]


def test_hot_branch_is_gone_without_hot_keys(spark):
    changes = I.user_changes(I.user_feed(spark, SF))
    versions = scd.scd2_history(changes, ["user_id"], tie_break=("event_id",))
    versions.collect()
    final = plan(versions).split("Initial Plan")[0]
    assert final.count("Window") == 1 and "BroadcastHashJoin" not in final and "Union" not in final


def test_last_events_are_combined_before_the_shuffle(spark):
    changes = I.user_changes(I.user_feed(spark, SF))
    text = plan(scd.scd1_latest(changes, ["user_id"], tie_break=("event_id",)))
    assert text.index("Exchange") < text.index("partial_max_by")
    assert shuffles(scd.scd1_latest(changes, ["user_id"])) == 1


def test_normalising_needs_no_shuffle(spark):
    rows = normalize.add_run_metadata(
        normalize.normalize_changes(I.user_feed_with_preimages(spark, SF)), "MRI"
    )
    assert "Exchange" not in plan(rows)


def test_narrow_entity_reads_two_columns(spark):
    text = plan(I.silver_rows(spark, SF, "customer_narrow"))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in text


def test_fact_reads_only_the_keys_of_its_dimension(spark):
    text = plan(Q.fact_order(spark, SF))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in text
    assert "c_name" not in text


@pytest.mark.parametrize("name", ["dim_customer", "dim_supplier", "fact_order", "fact_order_lines"])
def test_joins_without_broadcast_are_by_key(spark, name):
    limit = {"spark__sql__autoBroadcastJoinThreshold": "-1"}
    with settings(spark, **limit):
        text = plan(Q.QUERIES[name](spark, SF))
    assert "SortMergeJoin" in text
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BroadcastHashJoin", text)


def test_orders_of_a_hot_customer_are_split(spark):
    orders = I.silver_rows(spark, SF, "order")
    copies = orders.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("copy")
    skewed = copies.withColumn(
        "o_custkey", F.when(F.col("o_custkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))
    )
    limits = {
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__autoBroadcastJoinThreshold": "0",
        "spark__sql__shuffle__partitions": "16",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "1KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4KB",
    }
    with settings(spark, **limits):
        fact = gold.fact_order(skewed.repartition(8), Q.dim_customer(spark, SF))
        assert len(fact.collect()) == skewed.count()
        assert "skew=true" in plan(fact)


def test_marker_rows_do_not_leave_the_hot_branch(spark):
    frame = feeds.frame(spark, feeds.random_events(21))
    versions = scd.scd2_history(frame, ["k"], tie_break=("n",), hot_rows=1)
    assert versions.where("v is null or _raw_change_type is null").count() == 0
