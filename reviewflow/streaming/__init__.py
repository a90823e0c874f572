"""Structured Streaming queries built from the batch operators."""
