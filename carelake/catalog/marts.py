"""Queries of the fact marts."""

from __future__ import annotations

from carelake.catalog import fact_sql, flat_sql, stage
from carelake.catalog.registry import register
from carelake.catalog.render import plain
from carelake.plans import facts


def oracle(sql: str) -> str:
    """Oracle over flat tables and fact marts."""
    return flat_sql.with_tables(sql, fact_sql.RAW)


for _name in facts.FACTS:
    register(
        _name,
        lambda spark, sf, n=_name: plain(facts.FACTS[n](stage.Tables(spark, sf), stage.AS_OF)),
        oracle(fact_sql.fact_oracle(_name)),
    )
