"""Incremental (Structured Streaming) loads of arriving observation files."""

from obsgate.streaming.ingest import line_stream, start_ingest

__all__ = ["line_stream", "start_ingest"]
