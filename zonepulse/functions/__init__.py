"""Column expression builders (built-in Spark expressions only)."""
