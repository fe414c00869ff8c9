"""Re-nesting operators: flat child tables back to one row per entity.

:func:`assemble` brings a main table and all its child tables together with one
shuffle: the inputs are stacked, one nullable struct column each, and grouped
once by the entity key, instead of one aggregation and one join per child.  The
size of a group is bounded by the source resource it was flattened from.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from carelake.functions import columns as C

MAIN = "_main"


def part(df: DataFrame, key: str, **fields: Column) -> DataFrame:
    """Child rows as ``(key, item)``; the order of the fields is the sort order."""
    return df.select(F.col(key), F.struct(*[v.alias(k) for k, v in fields.items()]).alias("item"))


def assemble(
    main: DataFrame,
    key: str,
    lists: dict[str, DataFrame] | None = None,
    sets: dict[str, DataFrame] | None = None,
    singles: dict[str, DataFrame] | None = None,
    keys: DataFrame | None = None,
    inside: bool = True,
    wanted: Collection[str] | None = None,
) -> DataFrame:
    """Main columns plus one sorted array per child.

    Arrays are sorted by their native ordering (``sort_array``), which is
    compiled, unlike the comparator of ``array_sort``.  ``lists`` keep repeats, ``sets`` drop them, ``singles`` hold at most one row
    per key and stay a struct.  Absent children give an empty array (or NULL
    struct).  ``main`` has one row per key.  With ``keys`` only the entities with
    (or without, if not ``inside``) one of these keys are nested.  ``wanted`` names the
    main columns and children that are read (None: all): the others are not stacked,
    and are NULL.
    """
    lists, sets, singles = lists or {}, sets or {}, singles or {}
    unread = {}
    if wanted is not None:
        unread = {f.name: f.dataType for f in main.schema if f.name != key and f.name not in wanted}
        for name, df in {**lists, **sets, **singles}.items():
            if name not in wanted:
                kind = df.schema["item"].dataType
                unread[name] = kind if name in singles else ArrayType(kind)
    columns = [c for c in (*main.columns, *lists, *sets, *singles) if c != key]
    lists, sets, singles = ({n: df for n, df in x.items() if n not in unread} for x in (lists, sets, singles))
    fields = [c for c in main.columns if c != key and c not in unread]
    stacked = [main.select(key, F.struct(*(fields or [F.lit(True)])).alias(MAIN))]
    for name, df in {**lists, **sets, **singles}.items():
        stacked.append(df.select(F.col(df.columns[0]).alias(key), F.col("item").alias(name)))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)
    # Groups are small, so partial lists would not shrink the data; shuffling the
    # plain rows first is about twice as fast as shuffling serialized lists.
    rows = union.repartition(key)
    if keys is not None:
        rows = rows.join(keys, key, "left_semi" if inside else "left_anti")
    grouped = rows.groupBy(key).agg(
        F.first(MAIN, ignorenulls=True).alias(MAIN),
        *[F.sort_array(F.collect_list(n)).alias(n) for n in lists],
        *[F.sort_array(F.collect_set(n)).alias(n) for n in sets],
        *[F.first(n, ignorenulls=True).alias(n) for n in singles],
    )

    def output(c: str) -> Column:
        if c in unread:
            return F.lit(None).cast(unread[c]).alias(c)
        return F.col(f"{MAIN}.{c}").alias(c) if c in fields else F.col(c)

    return grouped.filter(F.col(MAIN).isNotNull()).select(key, *map(output, columns))


def null_if_empty(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def without(items: Column, *fields: str) -> Column:
    """Array elements without the given sort-only fields."""
    return F.transform(items, lambda x: x.dropFields(*fields))


def ranked(items: Column, *drop: str) -> Column:
    """Sorted elements with their 1-based position as ``rank``."""

    def number(x: Column, i: Column) -> Column:
        x = x.dropFields(*drop) if drop else x
        return x.withField("rank", i + 1)

    return F.transform(items, number)


def joined_text(items: Column, render, delimiter: str) -> Column:
    """Rendered elements joined to text; NULL for no elements."""
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, render), delimiter))


def to_json_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for sinks without nested types."""
    return df.select(*[
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct") else F.col(f.name)
        for f in df.schema
    ])


# --- the same building blocks on flat tables ------------------------------------


def nest_children(df: DataFrame, key: str, name: str, distinct: bool = False, **fields: Column) -> DataFrame:
    """``(key, name)``: sorted array of child structs per key."""
    items = part(df, key, **fields)
    if distinct:
        items = items.distinct()
    return items.groupBy(key).agg(F.sort_array(F.collect_list("item")).alias(name))


def rank_codes(df: DataFrame, key: str, systems, code: str = "code_code", system: str = "code_system") -> DataFrame:
    """Codes of each entity ranked by system priority, then code."""
    order = Window.partitionBy(key).orderBy(
        C.system_priority(F.col(system), systems), F.col(code).asc_nulls_last(),
        F.xxhash64(*df.columns),
    )
    return df.filter(F.col(code).isNotNull()).withColumn("code_rank", F.row_number().over(order))


def primary_code(df: DataFrame, key: str, systems, fields, code: str = "code_code", system: str = "code_system") -> DataFrame:
    """First-ranked code per entity by aggregation: combines before the shuffle."""
    order = F.struct(C.system_priority(F.col(system), systems), F.col(code), F.xxhash64(*df.columns))
    best = F.min_by(F.struct(*fields), order).alias("best")
    return df.filter(F.col(code).isNotNull()).groupBy(key).agg(best).select(key, "best.*")


def best_row(df: DataFrame, keys, *order: Column) -> DataFrame:
    """First row per key in the given order, limited before the shuffle as well."""
    window = Window.partitionBy(keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def distinct_text(df: DataFrame, keys: list[str], value: Column, name: str, delimiter: str) -> DataFrame:
    """Sorted distinct texts per key in one string.

    Repeats go in a first, evenly spread aggregation, so a key with very many
    rows reaches its final group with its distinct values only.
    """
    pairs = df.select(*keys, value.alias("_value")).filter("_value is not null").distinct()
    return pairs.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_list("_value")), delimiter).alias(name)
    )


def distinct_counts(df: DataFrame, key: str, counted: str, **conditions: Column) -> DataFrame:
    """Distinct ``counted`` per key, overall and under conditions.

    Two steps replace one multi-distinct expansion: one row per (key, counted)
    with the conditions folded in, then plain sums that combine before the
    shuffle; a hot key is spread over its ids in the first step.
    """
    flags = [F.max(F.coalesce(cond, F.lit(False)).cast("int")).alias(n) for n, cond in conditions.items() if n != "total"]
    once = df.filter(F.col(counted).isNotNull()).groupBy(key, counted).agg(F.lit(1).alias("total"), *flags)
    names = ["total", *[n for n in conditions if n != "total"]]
    return once.groupBy(key).agg(*[F.sum(n).alias(n) for n in names])
