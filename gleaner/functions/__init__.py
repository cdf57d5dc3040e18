"""Column functions and lexicons."""
