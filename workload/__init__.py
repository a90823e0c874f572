"""Queries over the given tables, each next to its SQL counterpart."""
