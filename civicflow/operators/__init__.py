"""Operators on DataFrames: each takes tables and parameters and returns a table."""
