"""Queries over the fixture tables and the SQL that restates each of them."""

from rankframe.checks.oracles import oracle_sql
from rankframe.checks.queries import queries

__all__ = ["oracle_sql", "queries"]
