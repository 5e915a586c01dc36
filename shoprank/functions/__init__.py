"""Column-level functions: predicates, dates, numerics."""
