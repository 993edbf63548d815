"""Column builders from Spark's own functions."""
