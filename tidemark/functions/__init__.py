"""Column expressions: casts, rates, calendar parts, labels and map projection."""
