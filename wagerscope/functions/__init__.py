"""Column expressions and distributed scans shared by the operators."""
