"""Column in, column out."""
