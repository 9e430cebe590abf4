"""Whole jobs: read, transform, write."""
