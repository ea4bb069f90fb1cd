"""Column functions: character classes and small building blocks."""
