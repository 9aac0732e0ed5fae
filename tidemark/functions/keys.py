"""Key expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.names import BUSINESS_KEY


def business_key(
    columns: Sequence[str | Column],
    delimiter: str = "|",
    alias: str = BUSINESS_KEY,
) -> Column:
    """Join the text form of ``columns`` with ``delimiter``.

    NULL parts are skipped, as ``concat_ws`` does, and the delimiter is not escaped.
    """
    if isinstance(columns, (str, Column)):
        raise TypeError("pass the key columns as a list")
    if not columns:
        raise ValueError("a business key needs at least one column")
    for part in columns:
        if not isinstance(part, (str, Column)):
            raise TypeError(f"key columns are names or Columns, not {type(part).__name__}")
    parts = [F.col(part) if isinstance(part, str) else part for part in columns]
    return F.concat_ws(delimiter, *[part.cast("string") for part in parts]).alias(alias)


def number_key(column: str) -> Column:
    """64-bit hash key of a whole number: the same for every width that can hold it."""
    value = F.col(column)
    fits = value.between(-(1 << 31), (1 << 31) - 1)
    return F.when(fits, F.xxhash64(value.cast("int"))).otherwise(F.xxhash64(value))


def surrogate_key(*columns: str) -> Column:
    """64-bit hash key: of the value itself for one column, of the '-'-joined values for several."""
    if len(columns) == 1:
        return F.xxhash64(columns[0])
    return F.xxhash64(F.concat_ws("-", *columns))
