"""Structured Streaming runner of the change log."""
