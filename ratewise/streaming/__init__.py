"""Incremental ingest of rating lines with Structured Streaming."""

from .ingest import compact_ratings, read_keyed_ratings, read_rejects, start_ratings_ingest

__all__ = ["compact_ratings", "read_keyed_ratings", "read_rejects", "start_ratings_ingest"]
