"""Queries of the normalizers: one per flat table."""

from __future__ import annotations

from carelake.catalog import flat_sql, stage
from carelake.catalog.registry import register
from carelake.catalog.render import plain
from carelake.operators.flatten import RULES

for _table, _rule in RULES.items():
    _kind = "main" if _rule.is_main else "child"
    register(
        f"{_kind}_{_table}",
        lambda spark, sf, t=_table: plain(stage.table(spark, sf, t)),
        flat_sql.table_oracle(_table),
    )
