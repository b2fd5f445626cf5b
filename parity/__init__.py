"""Registered queries, each next to the SQL that must give the same rows."""

from parity import consumer_queries, monitoring_queries, product_queries, quality_queries, source_queries  # noqa: F401
from parity.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
