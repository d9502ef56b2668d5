"""Column-level rules."""
