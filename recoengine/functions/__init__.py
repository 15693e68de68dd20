"""Column expressions (built-in Spark functions only) and fixed values."""
