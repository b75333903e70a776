"""Inkwell operators."""
