"""Streaming jobs and sinks."""
