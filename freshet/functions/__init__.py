"""Column functions: each returns a Column built from Spark built-ins."""
