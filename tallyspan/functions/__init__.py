"""Column expressions: measures, labels, cleaning."""
