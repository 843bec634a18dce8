"""Registered queries.  Importing this package fills the registry."""

from tidemark.queries import oracle_parts  # noqa: F401
from tidemark.queries import gold, factor_queries, job_queries, quality_queries, op_queries  # noqa: F401
from tidemark.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
