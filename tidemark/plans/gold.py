"""Star schema over the current rows of the silver entities.

Joins carry no broadcast hints: a lookup side is broadcast when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``, else both sides are shuffled and adaptive execution splits
partitions that one key has made too large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.functions.calendar import calendar_columns, date_key
from tidemark.functions.keys import number_key, surrogate_key
from tidemark.operators.members import with_unknown_member

MONEY = "decimal(15,2)"

# First and last day of the calendar, declared columns of the order fact.
FIRST_DAY = "2000-01-01"
LAST_DAY = "2030-12-31"
FACT_SCHEMA = {
    "order_key": "bigint",
    "customer_surrogate_key": "bigint",
    "order_date_key": "int",
    "order_status": "string",
    "order_priority": "string",
    "clerk_name": "string",
    "ship_priority": "int",
    "total_price": MONEY,
    "order_comment": "string",
    "order_date": "date",
    "created_at": "timestamp",
    "updated_at": "timestamp",
}
LINE_TOTALS = {
    "total_quantity": "l_quantity",
    "total_discount": "l_discount",
    "total_tax": "l_tax",
    "total_extended_price": "l_extendedprice",
}


def dim_customer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    located = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    members = located.select(
        surrogate_key("c_custkey", "n_nationkey", "r_regionkey").alias("customer_surrogate_key"),
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("customer_name"),
        F.col("c_address").alias("customer_address"),
        F.col("c_phone").alias("customer_phone"),
        F.col("c_acctbal").alias("customer_account_balance"),
        F.col("c_mktsegment").alias("customer_market_segment"),
        F.col("c_comment").alias("customer_comment"),
        F.col("n_name").alias("nation_name"),
        F.col("r_name").alias("region_name"),
        F.col("n_nationkey").alias("nation_key"),
        F.col("r_regionkey").alias("region_key"),
    )
    return with_unknown_member(members)


def dim_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    located = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    members = located.select(
        surrogate_key("n_nationkey").alias("nation_surrogate_key"),
        F.col("n_nationkey").alias("nation_key"),
        F.col("n_name").alias("nation_name"),
        F.col("n_regionkey").alias("region_key"),
        F.col("r_name").alias("region_name"),
        F.col("n_comment").alias("nation_comment"),
    )
    return with_unknown_member(members)


def dim_region(region: DataFrame) -> DataFrame:
    members = region.select(
        surrogate_key("r_regionkey").alias("region_surrogate_key"),
        F.col("r_regionkey").alias("region_key"),
        F.col("r_name").alias("region_name"),
        F.col("r_comment").alias("region_comment"),
    )
    return with_unknown_member(members)


def dim_supplier(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    located = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    members = located.select(
        number_key("s_suppkey").alias("supplier_surrogate_key"),
        F.col("s_suppkey").alias("supplier_key"),
        F.col("s_name").alias("supplier_name"),
        F.col("s_address").alias("supplier_address"),
        F.col("s_nationkey").alias("nation_key"),
        F.col("n_name").alias("nation_name"),
        F.col("n_regionkey").alias("region_key"),
        F.col("r_name").alias("region_name"),
        F.col("s_phone").alias("supplier_phone"),
        F.col("s_acctbal").alias("supplier_account_balance"),
        F.col("s_comment").alias("supplier_comment"),
    )
    return with_unknown_member(members)


def dim_part(part: DataFrame) -> DataFrame:
    members = part.select(
        number_key("p_partkey").alias("part_surrogate_key"),
        F.col("p_partkey").alias("part_key"),
        F.col("p_name").alias("part_name"),
        F.col("p_mfgr").alias("part_manufacturer"),
        F.col("p_brand").alias("part_brand"),
        F.col("p_type").alias("part_type"),
        F.col("p_size").alias("part_size"),
        F.col("p_container").alias("part_container"),
        F.col("p_retailprice").cast(MONEY).alias("part_retail_price"),
        F.col("p_comment").alias("part_comment"),
    )
    return with_unknown_member(members)


def dim_part_supplier(partsupp: DataFrame) -> DataFrame:
    members = partsupp.select(
        surrogate_key("ps_partkey", "ps_suppkey").alias("part_supplier_key"),
        F.col("ps_partkey").alias("part_key"),
        F.col("ps_suppkey").alias("supplier_key"),
        F.col("ps_availqty").alias("available_quantity"),
        F.col("ps_supplycost").cast(MONEY).alias("supply_cost"),
        F.col("ps_comment").alias("comment"),
    )
    return with_unknown_member(members)


def dim_date(spark: SparkSession, first_day: str = FIRST_DAY, last_day: str = LAST_DAY) -> DataFrame:
    """One row per day, both ends included, and the unknown day."""
    bounds = [F.lit(day).cast("date") for day in (first_day, last_day)]
    days = spark.range(0, 1, 1, 1).select(
        F.explode(F.sequence(*bounds, F.expr("interval 1 day"))).alias("full_date")
    )
    unknown_year = F.lit(N.FIRST_START[:4])
    return with_unknown_member(
        days.select(*calendar_columns(F.col("full_date"))), year=unknown_year, fiscal_year=unknown_year
    )


def fact_order(orders: DataFrame, customers: DataFrame, *carried: str) -> DataFrame:
    """Orders with the surrogate key of their customer, -1 where there is none.

    ``customers`` is the customer dimension, one row per customer key. Works on batch and streaming
    orders; an order without a date has no date key. An event creates and updates its order when it was committed; where
    events are merged, the first creation stays.
    """
    lookup = customers.select(
        F.col("customer_key").alias("_customer_key"), "customer_surrogate_key"
    )
    matched = orders.join(lookup, F.col("o_custkey") == F.col("_customer_key"), "left")
    columns = {
        "order_key": F.col("o_orderkey"),
        "customer_surrogate_key": F.coalesce("customer_surrogate_key", F.lit(N.UNKNOWN_KEY)),
        "order_date_key": date_key(F.col("o_orderdate")),
        "order_status": F.col("o_orderstatus"),
        "order_priority": F.col("o_orderpriority"),
        "clerk_name": F.col("o_clerk"),
        "ship_priority": F.col("o_shippriority"),
        "total_price": F.col("o_totalprice"),
        "order_comment": F.col("o_comment"),
        "order_date": F.col("o_orderdate"),
        "created_at": F.col(N.RAW_COMMIT_TIMESTAMP),
        "updated_at": F.col(N.RAW_COMMIT_TIMESTAMP),
    }
    typed = [columns[name].cast(kind).alias(name) for name, kind in FACT_SCHEMA.items()]
    return matched.select(*typed, *carried)


def order_line_totals(lineitem: DataFrame) -> DataFrame:
    """Exact sums over the lines of each order."""
    sums = [
        F.sum(F.col(source).cast(MONEY)).cast(MONEY).alias(name) for name, source in LINE_TOTALS.items()
    ]
    return lineitem.groupBy("l_orderkey").agg(*sums, F.count(F.lit(1)).alias("line_item_count"))


def fact_order_lines(fact: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The order fact with its line totals, 0 for orders without lines."""
    totals = order_line_totals(lineitem)
    joined = fact.join(totals, F.col("order_key") == F.col("l_orderkey"), "left")
    amounts = [F.coalesce(name, F.lit(0)).cast(MONEY).alias(name) for name in LINE_TOTALS]
    count = F.coalesce("line_item_count", F.lit(0)).alias("line_item_count")
    return joined.select(*fact.columns, *amounts, count)
