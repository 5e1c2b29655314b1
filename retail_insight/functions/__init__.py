"""Column-level helpers; all are native Spark expressions."""
