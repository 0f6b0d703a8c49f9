"""Column expressions and cleaning steps."""
