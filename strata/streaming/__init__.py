"""Incremental scoring of newly arriving files with Structured Streaming."""
