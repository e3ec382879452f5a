"""Column expressions: range assignment and delimited fields."""
