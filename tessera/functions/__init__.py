"""Column expressions: rates, intervals of proportions, text and sequence helpers."""
