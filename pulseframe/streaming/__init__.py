"""Structured Streaming: keyed state, the monitoring query, its sinks."""
