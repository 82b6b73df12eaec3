"""Registered queries with their SQL twins, over inputs derived from the given tables."""
