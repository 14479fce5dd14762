"""Operators for training-data pipelines; nothing else in the package imports this subpackage."""

from boardsmith.llm.queries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
