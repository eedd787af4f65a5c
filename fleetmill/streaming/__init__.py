"""Structured Streaming queries, sinks and replays."""
