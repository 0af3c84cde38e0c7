"""Structured Streaming forms of the event-table operators."""
