"""DataFrame operators: deduplication, ranking, counting, merging, selection, audits."""
