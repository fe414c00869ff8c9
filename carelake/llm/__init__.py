"""Operators of training-data pipelines and their registered queries."""


def load_queries() -> None:
    """Import every module that registers queries."""
    from carelake.llm import queries  # noqa: F401
