"""Column expressions: lenient casts, calendar parts, geo scores."""
