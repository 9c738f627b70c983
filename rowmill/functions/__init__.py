"""Column-in, Column-out functions; every one is a native Spark expression."""
