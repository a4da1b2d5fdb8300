"""Operators on comparison tables."""
