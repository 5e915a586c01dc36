"""Verification support: DuckDB oracle SQL and a result comparer."""
