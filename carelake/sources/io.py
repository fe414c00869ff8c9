"""Readers and sinks of resources, flat tables and marts.

A sink never overwrites the folder its input is read from: a load writes a new
folder (or appends), and readers move on to it when it is complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from carelake.sources import schemas


# --- sources --------------------------------------------------------------


def read_resource(spark: SparkSession, resource: str, path: str | None = None, table: str | None = None,
                  file_format: str = "parquet") -> DataFrame:
    """Nested resource from files or a catalog table.

    Files are read with the full explicit schema: fields a file lacks are NULL,
    nothing is inferred, and only the nested fields in use are scanned.  Columnar
    files that hold extensions below extensions as columns are turned into the
    JSON text the schema has there.
    """
    schema = schemas.resource_schema(resource)
    if table is not None:
        return conform(spark.table(table), schema)
    if file_format in ("parquet", "orc"):
        own = spark.read.format(file_format).load(path)  # reads a footer
        if _has_text_for_nested(own.schema, schema):
            return conform(own, schema)
    return spark.read.schema(schema).format(file_format).load(path)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Top-level columns of ``schema`` in order; absent ones are typed NULLs.

    Names are matched without regard to case.  Where the schema has text and the
    frame something nested (extensions below extensions), it becomes JSON text.
    """
    present = {f.name.lower(): f for f in df.schema}

    def one(f: StructField) -> Column:
        have = present.get(f.name.lower())
        if have is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return _fitted(F.col(have.name), have.dataType, f.dataType).alias(f.name)

    return df.select(*[one(f) for f in schema])


def _fitted(value: Column, have: DataType, want: DataType) -> Column:
    """``value`` as ``want``; nested fields are rebuilt only where text takes the place of something nested."""
    if isinstance(want, StringType) and isinstance(have, (ArrayType, StructType, MapType)):
        return F.to_json(value)
    if not _has_text_for_nested(have, want):
        return value.cast(want)
    if isinstance(want, ArrayType):
        return F.transform(value, lambda x: _fitted(x, have.elementType, want.elementType))
    fields = {f.name.lower(): f for f in have}
    parts = [
        (_fitted(value[fields[f.name.lower()].name], fields[f.name.lower()].dataType, f.dataType)
         if f.name.lower() in fields else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in want
    ]
    return F.when(value.isNotNull(), F.struct(*parts))


def _has_text_for_nested(have: DataType, want: DataType) -> bool:
    if isinstance(want, StringType):
        return isinstance(have, (ArrayType, StructType, MapType))
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return _has_text_for_nested(have.elementType, want.elementType)
    if isinstance(want, StructType) and isinstance(have, StructType):
        wanted = {f.name.lower(): f.dataType for f in want}
        return any(_has_text_for_nested(f.dataType, wanted[f.name.lower()]) for f in have if f.name.lower() in wanted)
    return False


def read_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    return spark.read.schema(schemas.table_schema(table)).parquet(path)


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schemas.table_schema(table))


def newest(df: DataFrame, column: str) -> DataFrame:
    """One row: the largest value of a column (a pushed-down aggregate on parquet)."""
    return df.agg(F.max(column).alias(f"max_{column}"))


def sample_rows(df: DataFrame, rows: int | None) -> DataFrame:
    """At most ``rows`` rows for a trial run; all rows when None."""
    return df if rows is None else df.limit(rows)


# --- sinks ----------------------------------------------------------------


def _write(df: DataFrame, path: str, mode: str, dry_run: bool) -> DataFrame:
    if not dry_run:
        df.write.mode(mode).parquet(path)
    return df


def full_refresh(df: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """Replace the folder's content. With ``dry_run`` the frame is returned unwritten."""
    return _write(df, path, "overwrite", dry_run)


def append(df: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    return _write(df, path, "append", dry_run)


def bookmark_sink(df: DataFrame, path: str, has_mark: bool, dry_run: bool = False) -> DataFrame:
    """Overwrite on the first load, append to later ones."""
    return _write(df, path, "append" if has_mark else "overwrite", dry_run)


def write_json_lines(df: DataFrame, path: str, mapping: dict[str, str] | None = None) -> None:
    """Nested rows as JSON lines; ``mapping`` selects and renames (source -> target)."""
    if mapping:
        df = df.select(*[F.col(s).alias(t) for s, t in mapping.items()])
    df.write.mode("overwrite").json(path)


def save_bucketed(df: DataFrame, table: str, key: str, order: list[str], buckets: int) -> None:
    """Catalog table bucketed by ``key``: merges and joins on it skip the shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *order).saveAsTable(table)
