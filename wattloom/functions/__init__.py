"""Column expressions: calendar labels, distances, JSON text."""
