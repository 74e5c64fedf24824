"""The operators as queries over the given tables, and their SQL counterparts."""

from .oracle import oracle_sql
from .queries import queries

__all__ = ["oracle_sql", "queries"]
