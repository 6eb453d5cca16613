"""Column expressions: money, scalars and key hashing."""
