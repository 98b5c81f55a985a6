"""Continuous forms of landing and folding, on Structured Streaming."""
