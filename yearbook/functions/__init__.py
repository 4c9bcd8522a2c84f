"""Scalar column functions. All are built from Spark SQL built-ins."""
