"""The registered queries (Spark plans) and their SQL equivalents."""

from bigraph.plans.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
