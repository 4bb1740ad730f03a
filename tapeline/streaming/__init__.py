"""Structured Streaming forms of the polling jobs. Each has a batch counterpart with the same result."""
