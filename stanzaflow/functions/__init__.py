"""Column expressions and page functions."""
