"""Inkwell plans."""
