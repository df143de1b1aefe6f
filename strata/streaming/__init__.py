"""Incremental processing as Structured Streaming (availableNow)."""

from .incremental import clean_batch, upsert_stream

__all__ = ["clean_batch", "upsert_stream"]
