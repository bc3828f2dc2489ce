"""Column expressions: text, numbers, dates and classification rules."""
