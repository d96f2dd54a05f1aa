"""Column expressions: periods, guarded arithmetic, windows, constants."""
