"""Column functions: guarded arithmetic, point-in-time and cross-sectional statistics."""
