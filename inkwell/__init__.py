"""Inkwell package."""
