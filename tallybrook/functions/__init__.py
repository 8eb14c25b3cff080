"""Column expressions: every one of them is a composition of Spark built-ins."""
