"""Column expressions: names and times, geometry, pixels, quality rules."""
