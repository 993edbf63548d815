"""Operators for large text corpora, kept apart from the rest of the library."""
