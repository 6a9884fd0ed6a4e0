"""Column expressions: parsing, derived columns, row rules."""
