"""Column-level rules and helpers."""
