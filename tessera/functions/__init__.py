"""Column helpers shared by every operator (names, type families, long-form per-column aggregates)."""
