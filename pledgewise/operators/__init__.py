"""DataFrame operators: interval joins, deduplication, merges, statistics and validation."""
