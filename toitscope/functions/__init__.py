"""Column expressions: text to typed values, labels, measures."""
