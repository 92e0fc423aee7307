"""Column expressions: text, status rules and shape arithmetic."""
