"""Column expressions: text, JSON, vectors, errors and markup."""
