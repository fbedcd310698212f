"""Structured Streaming: topics, windows and runs."""
