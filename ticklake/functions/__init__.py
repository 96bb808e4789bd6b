"""Column functions: instants, paths."""
