"""Structured Streaming appends."""
