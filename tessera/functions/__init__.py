"""Column expressions (no Python UDFs): text cleaning, distances, numbers."""
