"""Structured Streaming: starting queries and the sinks they write to."""
