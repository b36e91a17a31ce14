"""Incremental sweep of an inbox with Structured Streaming."""
