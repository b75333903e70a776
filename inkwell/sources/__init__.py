"""Inkwell sources."""
