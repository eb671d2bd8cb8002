"""Structured Streaming: incremental rollups and first-seen appends."""
