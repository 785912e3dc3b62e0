"""Column expressions: cleaning, typing, calendar parts, measures."""
