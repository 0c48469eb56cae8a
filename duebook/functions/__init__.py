"""Column expressions: bands, keys, probability functions and text."""
