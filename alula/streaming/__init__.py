"""Structured Streaming jobs over arriving logs, files and shapes."""
