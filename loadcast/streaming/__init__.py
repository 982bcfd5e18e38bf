"""Structured Streaming: scoring feature records as they arrive."""
