"""Registered queries over the given tables, each beside equivalent SQL."""
