"""Column expressions: scalars, dates and hashes."""
