"""Structured Streaming: bounded drains into bronze and keyed upserts."""
