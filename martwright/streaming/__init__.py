"""Continuous loading with Structured Streaming."""
