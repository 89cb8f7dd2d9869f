"""Lookups of names that arrive as a stream."""
