"""Column expressions: time, JSON and text."""
