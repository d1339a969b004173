"""Structured Streaming driver for the periodic load (foreachBatch)."""

from tidemark.streaming.incremental import already_loaded, file_stream, start_incremental_load

__all__ = ["already_loaded", "file_stream", "start_incremental_load"]
