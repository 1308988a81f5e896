"""Composed read queries and the build order of the tables."""
