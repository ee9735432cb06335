"""Column expressions: business rules and exact arithmetic."""
