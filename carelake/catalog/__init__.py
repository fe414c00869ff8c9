"""Registered queries: every operator run on the driver tables, with its oracle."""


def load_all() -> None:
    """Import every module that registers queries."""
    from carelake.catalog import aggregates, expressions, increments, loads, marts, normalizers, quality, reports  # noqa: F401
