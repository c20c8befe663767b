"""Column expressions over trips."""
