"""Column expressions (built-in Spark functions only): parsing and measures."""
