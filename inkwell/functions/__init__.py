"""Inkwell functions."""
