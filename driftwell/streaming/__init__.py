"""Structured Streaming: applying change logs, offsets, control."""
