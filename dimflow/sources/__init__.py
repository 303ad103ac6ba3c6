"""Readers of landed documents and published tables."""
