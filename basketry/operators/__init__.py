"""Operators: prepare (split), encode (dictionaries, matrix, truth), als,
rules (itemsets, rules, scoring), metrics (ranking metrics), predict
(cohort, switch, nesting) and report (report tables)."""
