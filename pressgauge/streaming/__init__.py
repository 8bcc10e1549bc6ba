"""Structured Streaming forms of the hourly jobs."""
