"""Stateful streaming operators and helpers to run them."""
