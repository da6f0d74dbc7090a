"""Readers of schemas and rows."""
