"""Incremental loads with Structured Streaming (file sources, availableNow)."""
