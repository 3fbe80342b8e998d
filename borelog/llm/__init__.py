"""Operators on text corpora."""
