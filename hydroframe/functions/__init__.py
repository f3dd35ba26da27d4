"""Column builders: scalar functions, unit rules and geometry predicates."""
