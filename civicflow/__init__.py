"""A PySpark engine for public-finance data pipelines."""
