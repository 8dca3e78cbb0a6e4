"""DataFrame operators: sliding windows, block-list lookups and merges, relational queries."""
