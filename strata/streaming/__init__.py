"""Structured Streaming jobs over the events table (file source, availableNow)."""
