"""Plain, comparable form of results: no nested, decimal or temporal types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT = ("created_at", "updated_at", "etl_created_at", "etl_updated_at")
TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def text(col: Column, dtype: T.DataType) -> Column:
    """Value as text: fields by ``|`` (NULL left out), elements by ``;``."""
    if isinstance(dtype, T.ArrayType):
        return F.array_join(F.transform(col, lambda x: text(x, dtype.elementType)), ";")
    if isinstance(dtype, T.StructType):
        fields = [text(col[f.name], f.dataType) for f in dtype if f.name not in AUDIT]
        return F.when(col.isNotNull(), F.concat_ws("|", *fields))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, TIMESTAMP)
    return col.cast("string")


def plain(df: DataFrame) -> DataFrame:
    """Audit columns dropped; the rest as strings, longs and doubles."""

    def one(f: T.StructField) -> Column:
        col, dtype = F.col(f"`{f.name}`"), f.dataType
        if isinstance(dtype, (T.DecimalType, T.FloatType)):
            return col.cast("double")
        if isinstance(dtype, T.IntegralType):
            return col.cast("long")
        if isinstance(dtype, (T.StringType, T.DoubleType)):
            return col
        return text(col, dtype)

    return df.select(*[one(f).alias(f.name) for f in df.schema if f.name not in AUDIT])
