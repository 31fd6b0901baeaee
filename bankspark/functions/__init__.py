"""Column expressions: built-in functions only, no Python in the row path."""
