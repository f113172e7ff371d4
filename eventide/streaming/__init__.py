"""Structured Streaming jobs over the same operators as batch."""
