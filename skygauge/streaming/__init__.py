"""Structured Streaming: topics in, landed tables out, refresh and windows."""
