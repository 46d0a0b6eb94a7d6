"""Structured Streaming forms of the joins, filters and savers."""
