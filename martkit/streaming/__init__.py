"""Incremental ingestion with Structured Streaming."""

from martkit.streaming.incremental import extract_incremental, load_incremental

__all__ = ["extract_incremental", "load_incremental"]
