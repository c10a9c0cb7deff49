"""Structured Streaming entry points (load-once landing ingestion)."""

from ledgerlens.streaming.landing import ingest_available, landing_stream, start_landing_ingest  # noqa: F401
