"""Readers for every input."""
