"""Whole computations of the public-finance domain, and step lists that are run as pipelines."""
