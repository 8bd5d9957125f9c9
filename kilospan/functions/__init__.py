"""Column expressions: no frame is touched here."""
