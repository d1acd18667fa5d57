"""Structured Streaming queries over folders of arriving files."""
