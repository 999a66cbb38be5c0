"""Column expressions: text, scores, labels, buckets and safe casts."""
