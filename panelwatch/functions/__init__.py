"""Column expressions: parsing, number text, verifier answers, point rules."""
