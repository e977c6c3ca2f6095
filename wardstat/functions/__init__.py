"""Column expressions and name rules."""
