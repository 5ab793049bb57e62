"""Readers: each returns a batch or streaming DataFrame."""
