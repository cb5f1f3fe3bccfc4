"""Column expressions used by the operators (no Python UDF in this package)."""
