"""Streaming forms: drivers, upserts, windows and stateful travel checks."""
