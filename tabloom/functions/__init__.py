"""Column expressions: text, time, predicates and categories."""
