"""Structured Streaming over a growing scene store (an addition of this library)."""
