"""Whole jobs: read, check, transform, write."""
