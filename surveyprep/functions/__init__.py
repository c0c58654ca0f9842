"""Column-expression helpers: null-safe predicates, projection, WKT."""
