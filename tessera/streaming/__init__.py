"""Streaming scoring (L4 stream) over a file source."""
