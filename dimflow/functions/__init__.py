"""Column expressions: cleaning steps, labels and row images."""
