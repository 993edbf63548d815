"""State between runs: revisions, histories, upserts."""
