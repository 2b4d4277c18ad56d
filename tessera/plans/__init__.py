"""Composed work: base views over the driver tables, jobs (L1–L5) and the registered query catalog."""
