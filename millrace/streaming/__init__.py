"""Structured Streaming: commits, sinks, transaction assembly, whole-database change sync."""
