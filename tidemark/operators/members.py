"""The "Unknown" member of a dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import names as N


def with_unknown_member(dimension: DataFrame, **values: Column) -> DataFrame:
    """Append one row that facts without a match can point at.

    Key columns get -1, texts 'Unknown', flags false and other numbers 0, each in the type of its
    column; ``values`` overrides single columns.
    """
    filled = [
        values.get(field.name, _unknown(field)).cast(field.dataType).alias(field.name)
        for field in dimension.schema
    ]
    return dimension.unionByName(dimension.sparkSession.range(0, 1, 1, 1).select(*filled))


def _unknown(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return F.lit(N.UNKNOWN_TEXT)
    if isinstance(field.dataType, T.BooleanType):
        return F.lit(False)
    if isinstance(field.dataType, T.DateType):
        return F.lit(N.FIRST_START[:10])
    return F.lit(N.UNKNOWN_KEY if field.name.endswith("_key") else 0)
