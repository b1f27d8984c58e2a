"""Structured Streaming: incremental ingest, event-time windows, stream upserts."""
