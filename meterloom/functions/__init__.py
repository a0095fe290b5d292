"""Column expressions: calendar, scalar guards, error terms."""
