"""Structured Streaming: incremental, exactly-once CSV ingest."""
