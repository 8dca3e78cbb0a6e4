"""Column expressions: line grooming and JSON parsing, window aggregates, the flag rule."""
