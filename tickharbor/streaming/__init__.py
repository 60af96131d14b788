"""Structured Streaming forms. Each takes a stream and returns a stream or a started query."""
