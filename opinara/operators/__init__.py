"""Table operators: de-duplication, lookups, keys, ranks, statistics."""
