"""Structured Streaming delivery of change records."""
