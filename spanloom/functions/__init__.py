"""Column expressions: character classes, expansion, cleaning."""
