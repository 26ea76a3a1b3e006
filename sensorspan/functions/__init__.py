"""Column expressions: cleaning, casting, time buckets, threshold classes."""
