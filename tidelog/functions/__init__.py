"""Column functions; all compile to built-in Spark expressions."""
