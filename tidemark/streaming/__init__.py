"""Structured Streaming forms: sinks, stateful processors, late data."""
