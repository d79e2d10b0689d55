"""Structured Streaming versions of the polled feeds."""
