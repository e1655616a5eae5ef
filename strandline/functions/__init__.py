"""Column expressions: missing values, geometry, spectral indices."""
