"""Registered queries and their SQL: each applies operators to views of the given tables."""

from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
