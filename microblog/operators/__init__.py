"""DataFrame operators (batch and streaming-compatible where noted)."""
