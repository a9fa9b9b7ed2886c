"""Column expressions: text scalars, rule chains and fixed rule tables."""
