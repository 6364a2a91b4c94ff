"""Operators that prepare training data from whole text corpora."""
