"""Incremental ingest of the raw feeds (Structured Streaming)."""

from blotter.streaming.ingest import harmonize_stream

__all__ = ["harmonize_stream"]
