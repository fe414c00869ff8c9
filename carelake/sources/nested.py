"""Build nested columns of a given type from partial Python dicts and lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


def shape(dtype: DataType, value) -> Column:
    """Column of ``dtype``: dicts become structs (absent fields NULL), lists arrays.

    A ``(condition, value)`` pair gives the value where the condition holds.
    """
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(value, tuple):
        condition, inner = value
        return F.when(condition, shape(dtype, inner))
    if isinstance(dtype, StructType) and isinstance(value, dict):
        unknown = set(value) - set(dtype.fieldNames())
        if unknown:
            raise ValueError(f"no such fields: {sorted(unknown)}")
        return F.struct(*[shape(f.dataType, value.get(f.name)).alias(f.name) for f in dtype])
    if isinstance(dtype, ArrayType) and isinstance(value, list):
        return F.array(*[shape(dtype.elementType, v) for v in value]).cast(dtype)
    return (value if isinstance(value, Column) else F.lit(value)).cast(dtype)


def select_as(df, schema: StructType, values: dict, *kept: str):
    """Project ``df`` to ``schema`` from a partial dict of values, with the ``kept`` columns beside it."""
    unknown = set(values) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.select(*[shape(f.dataType, values.get(f.name)).alias(f.name) for f in schema], *kept)
