"""Structured Streaming: ingest, routing, forwarding, metrics."""
