"""Column expressions: text cleaning, labels, model answers, number formats."""
