"""Column expressions: text cleaning, period keys, guarded arithmetic."""
