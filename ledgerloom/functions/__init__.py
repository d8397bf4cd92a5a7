"""Column functions: every one builds native Spark expressions."""
