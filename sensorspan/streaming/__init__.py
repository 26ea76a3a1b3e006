"""Structured Streaming jobs over a directory of landed feed files."""
