"""Column functions and fixed label tables."""
