"""Registered queries over the given tables, each with SQL that must give the same rows."""

from tickharbor.plans.catalog import CATALOG, oracle_sql, queries

__all__ = ["CATALOG", "oracle_sql", "queries"]
