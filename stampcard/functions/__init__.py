"""Column functions: pure expressions, no I/O and no Python per row."""
