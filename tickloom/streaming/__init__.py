"""Structured Streaming: starting queries, batch sinks, progress rules."""
