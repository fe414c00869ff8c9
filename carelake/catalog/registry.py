"""Registry of queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, run: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} exists")
    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = " ".join(sql.split("\n")) if "--" not in sql else sql


def query(name: str, sql: str | None = None):
    def wrap(run: Query) -> Query:
        register(name, run, sql)
        return run

    return wrap
