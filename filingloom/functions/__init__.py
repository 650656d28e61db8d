"""Column functions: everything here is built from native Spark expressions."""
