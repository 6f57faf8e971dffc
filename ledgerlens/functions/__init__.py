"""Column expressions and parameter checks."""
