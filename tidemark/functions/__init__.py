"""Column expressions and windows."""
