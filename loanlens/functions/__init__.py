"""Column expressions: scalar functions, text formats and portfolio measures."""
