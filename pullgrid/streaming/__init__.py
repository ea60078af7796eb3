"""Structured Streaming jobs over the poll stream and the listing log."""
