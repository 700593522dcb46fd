"""Structured Streaming variants of the landing jobs."""

from incidentlake.streaming.ingest import ingest_available, stream_bronze, stream_silver

__all__ = ["ingest_available", "stream_bronze", "stream_silver"]
