"""Column expressions: no actions, no Python row code."""
