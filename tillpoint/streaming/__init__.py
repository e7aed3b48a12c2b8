"""Structured Streaming: micro-batch ingest with idempotent upserts,
de-duplication with an event-time life, heartbeat sessions."""
