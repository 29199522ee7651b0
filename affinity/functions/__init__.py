"""Column expressions: keyed hashing and vector arithmetic."""
