"""The incremental operators over streams."""
