"""Column functions: everything stays a built-in expression, no Python UDF."""
