"""Incremental scoring over arriving activity files (Structured Streaming)."""
