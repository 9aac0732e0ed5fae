"""Cleaned entities: which columns silver keeps, their types, keys and history kind."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.functions.keys import business_key
from tidemark.functions.metadata import silver_metadata


@dataclass(frozen=True)
class Entity:
    """One silver table. ``columns`` maps a column to its type, or to None where it stays as it is."""

    name: str
    source_system: str
    source: str
    keys: tuple[str, ...]
    columns: dict[str, str | None]
    scd_type: int = 2
    expressions: dict[str, str] = field(default_factory=dict)
    presented: bool = False


# The tables of the two source systems and the types readers of silver rely on.
ENTITIES = {
    entity.name: entity
    for entity in (
        Entity(
            "customer", "MRI", "h_customer", ("c_custkey",),
            {
                "c_custkey": "bigint", "c_name": None, "c_address": None, "c_nationkey": "int",
                "c_phone": "string", "c_acctbal": "double", "c_mktsegment": "string", "c_comment": None,
            },
        ),
        Entity(
            "nation", "MRI", "h_nation", ("n_nationkey",),
            {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int", "n_comment": "string"},
            presented=True,
        ),
        Entity(
            "region", "MRI", "h_region", ("r_regionkey",),
            {"r_regionkey": None, "r_name": "string", "r_comment": None},
        ),
        Entity(
            "part", "MRI", "h_part", ("p_partkey",),
            {
                "p_partkey": "bigint", "p_name": None, "p_mfgr": "string", "p_brand": "string",
                "p_type": None, "p_size": "int", "p_container": "string",
                "p_retailprice": "decimal(15,2)", "p_comment": None,
            },
        ),
        Entity(
            "order", "OAH", "h_order", ("o_orderkey",),
            {
                "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
                "o_totalprice": "double", "o_orderdate": "date", "o_orderpriority": "string",
                "o_clerk": "string", "o_shippriority": "int", "o_comment": None,
            },
            scd_type=1,
            expressions={"o_orderstatus": "substring(o_orderstatus, 1, 1)"},
        ),
        Entity(
            "supplier", "OAH", "h_supplier", ("s_suppkey",),
            {
                "s_suppkey": "bigint", "s_name": "string", "s_address": None, "s_nationkey": "int",
                "s_phone": "string", "s_acctbal": "double", "s_comment": None,
            },
        ),
        Entity(
            "partsupp", "OAH", "h_partsupp", ("ps_partkey", "ps_suppkey"),
            {
                "ps_partkey": "bigint", "ps_suppkey": "bigint", "ps_availqty": "int",
                "ps_supplycost": "double", "ps_comment": None,
            },
        ),
        Entity(
            "customer_narrow", "MRI", "h_customer", ("c_custkey",),
            {"c_custkey": "bigint", "c_name": None},
        ),
    )
}


def clean(
    bronze: DataFrame,
    entity: Entity,
    silver_time: Column | None = None,
    include_file_metadata: bool = False,
) -> DataFrame:
    """Business key, typed columns and audit columns of one entity; for batch and streaming rows."""
    typed = []
    for name, kind in entity.columns.items():
        value = F.expr(entity.expressions[name]) if name in entity.expressions else F.col(name)
        typed.append((value.cast(kind) if kind else value).alias(name))
    return bronze.select(
        business_key([*entity.keys, N.SOURCE_SYSTEM]),
        *typed,
        *silver_metadata(include_file_metadata, silver_time),
    )
