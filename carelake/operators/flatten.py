"""Normalizer engine: one nested resource -> one flat table.

A rule names the array path to explode (none for a main table), the output
columns and the rows to keep.  Columns a rule does not fill become typed NULLs
of the target schema, so every table always has its full, fixed layout.  All
rules are projections plus ``explode``: no shuffle, and only the nested fields a
table needs are read from the columnar source.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import columns as C
from carelake.sources import schemas


@dataclass(frozen=True)
class Rule:
    resource: str
    table: str
    key: str
    build: Callable[..., dict[str, Column]]
    levels: tuple[str | Callable[[], Column], ...] = ()
    required: tuple[str, ...] = ()
    any_of: tuple[str, ...] = ()
    positions: bool = False

    @property
    def is_main(self) -> bool:
        return not self.levels


RULES: dict[str, Rule] = {}


def rule(resource: str, table: str, key: str, levels=(), required=(), any_of=(), positions=False):
    """Register a builder ``f(*items) -> {column: expression}`` for a table.

    ``items`` are the exploded elements, outermost first; with ``positions`` the
    element position comes last.  The first level may be a function that gives the
    array to explode.
    """

    def register(build):
        RULES[table] = Rule(resource, table, key, build, tuple(levels), tuple(required), tuple(any_of), positions)
        return build

    return register


def _explode(df: DataFrame, levels, positions: bool) -> tuple[DataFrame, list[Column]]:
    items: list[str] = []
    for depth, path in enumerate(levels):
        source = path() if callable(path) else F.col(path) if depth == 0 else reduce(lambda c, f: c[f], path.split("."), F.col(items[-1]))
        names = [f"_item{depth}"]
        if positions and depth == len(levels) - 1:
            df = df.select("*", F.posexplode(source).alias("_position", names[0]))
        else:
            df = df.select("*", F.explode(source).alias(names[0]))
        items += names
    cols = [F.col(i) for i in items]
    return df, cols + ([F.col("_position")] if positions else [])


def flatten(resource: DataFrame, table: str, as_of=None) -> DataFrame:
    """Rows of ``table`` from a frame of its nested resource."""
    spec = RULES[table]
    df, items = _explode(resource, spec.levels, spec.positions) if spec.levels else (resource, [])
    columns = _columns(spec, items, as_of)
    return df.select(*[c.alias(name) for name, c in columns.items()]).filter(_complete(spec, {name: F.col(name) for name in columns}))


def _columns(spec: Rule, items: list[Column], as_of=None) -> dict[str, Column]:
    """All columns of a table, in the types and order of its schema."""
    filled = {spec.key: F.col("id"), **spec.build(*items)}
    schema = schemas.table_schema(spec.table)
    names = schema.fieldNames()
    if "created_at" in names:
        filled.update(C.audit_columns(as_of))
    if "meta_last_updated" in names and "meta_last_updated" not in filled:
        filled["meta_last_updated"] = C.parse_timestamp(F.col("meta.lastUpdated"))
    unknown = set(filled) - set(names)
    if unknown:
        raise ValueError(f"{spec.table}: columns not in schema: {sorted(unknown)}")
    return {f.name: filled.get(f.name, F.lit(None)).try_cast(f.dataType) for f in schema}


def _complete(spec: Rule, columns: dict[str, Column]) -> Column:
    """Whether a row has what its table requires."""
    keep = [columns[c].isNotNull() for c in (spec.key, *spec.required)]
    if spec.any_of:
        keep.append(F.coalesce(*[columns[c].cast("string") for c in spec.any_of]).isNotNull())
    return reduce(and_, keep)


def makes_row(table: str) -> Column:
    """Whether a nested resource makes a row of its main table."""
    spec = RULES[table]
    return _complete(spec, _columns(spec, []))


def flatten_all(resource: DataFrame, resource_name: str, as_of=None) -> dict[str, DataFrame]:
    """All tables of one resource, lazily."""
    return {t: flatten(resource, t, as_of) for t, r in RULES.items() if r.resource == resource_name}


def tables_of(resource_name: str) -> tuple[str, list[str]]:
    """(main table, child tables) of a resource."""
    own = [r for r in RULES.values() if r.resource == resource_name]
    return next(r.table for r in own if r.is_main), [r.table for r in own if not r.is_main]
