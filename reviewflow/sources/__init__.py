"""Readers and writers at the edge of the flow."""
