"""Column expressions: measures, dates, labels, text formats."""
