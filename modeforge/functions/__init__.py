"""Column expressions: no actions, no state."""
