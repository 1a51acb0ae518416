"""Each operator as a query over the given tables, with the SQL to check it."""

from tallymart.queries.registry import oracles, queries

__all__ = ["oracles", "queries"]
