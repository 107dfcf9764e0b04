"""Column-expression builders (no DataFrame actions)."""
