"""DataFrame operators: quality rules, dedup/upsert, skew-aware joins, windows, checks."""
