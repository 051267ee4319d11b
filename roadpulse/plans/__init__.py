"""Composed products."""
