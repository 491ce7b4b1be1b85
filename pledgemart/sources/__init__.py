"""Readers: landed JSON, id seeds and CSV marts."""
