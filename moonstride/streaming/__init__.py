"""Structured Streaming jobs."""

from moonstride.streaming.ingest import ingest_landing, stream_landing

__all__ = ["ingest_landing", "stream_landing"]
