"""Composed plans: test-data fixtures, the registered queries with their
DuckDB oracles (catalog, oracle, common) and the train / infer jobs
(workflows)."""
