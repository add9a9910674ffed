"""Structured Streaming: live query builders and a file-replay harness."""
