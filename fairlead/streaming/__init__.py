"""Incremental landing of files with Structured Streaming."""
