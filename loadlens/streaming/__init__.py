"""Structured Streaming versions of the hourly ingest, last activity and sessions."""

from loadlens.streaming.jobs import (  # noqa: F401
    ingest_batch, ingest_stream, last_activity_stream, sessions_stream,
)
