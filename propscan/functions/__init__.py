"""Column expressions that parse and normalise listing fields."""
