"""Compositions of operators: staging, dimensions, facts, measures, health."""
