"""Structured Streaming forms of the trailing-window products (ST-1 .. ST-5)."""
