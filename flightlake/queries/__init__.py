"""Queries over the test tables."""

from flightlake.queries import event_queries, load_queries, mart_queries, serve_queries, settle_queries, stream_queries, text_queries  # noqa: F401
from flightlake.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
