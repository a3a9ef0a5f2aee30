"""Shared column expressions (exprs), skew-safe in-group positions (ranking)
and size-checked broadcast joins (joins)."""
