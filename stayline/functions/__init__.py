"""Column expressions. Every function returns a built-in expression; none is a Python UDF."""
