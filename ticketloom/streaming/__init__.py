"""Structured Streaming jobs; each has a batch counterpart in ``operators``."""
