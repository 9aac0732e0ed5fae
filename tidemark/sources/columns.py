"""Columns of tables that evolve."""

from __future__ import annotations

from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

# Files of the first type can be read as the second.
_WIDER: tuple[tuple[type[DataType], type[DataType]], ...] = ((IntegerType, LongType), (FloatType, DoubleType))


def merged_columns(known: StructType | None, new: StructType) -> StructType:
    """``known`` and behind them the columns that ``new`` adds; of two number types the wider one."""
    fields = {field.name: field for field in known or []}
    for field in new:
        before = fields.get(field.name)
        kind = field.dataType if before is None else _common_type(field.name, before.dataType, field.dataType)
        fields[field.name] = StructField(field.name, kind, True)
    return StructType(list(fields.values()))


def _common_type(name: str, left: DataType, right: DataType) -> DataType:
    if left == right:
        return left
    for narrow, wide in _WIDER:
        if {type(left), type(right)} == {narrow, wide}:
            return wide()
    if isinstance(left, StructType) and isinstance(right, StructType):
        return merged_columns(left, right)
    raise ValueError(f"column {name} was {left.simpleString()} before and is {right.simpleString()} now")
