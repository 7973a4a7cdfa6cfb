"""Column-level helpers built only from Spark's own expressions."""
