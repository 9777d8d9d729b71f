"""Structured Streaming extensions over the ``events`` table."""
