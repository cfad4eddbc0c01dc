"""Data-quality checks; each returns the violating rows."""
