"""Column functions: paths, type tokens, numeric rules."""
