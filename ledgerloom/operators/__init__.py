"""Frame-level operators: dedup, lookups, table writes and merges, quality checks."""
