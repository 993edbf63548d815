"""The few functions that Spark has no built-in for, over Arrow batches."""
