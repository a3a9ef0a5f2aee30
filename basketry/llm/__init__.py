"""Operators of a large-scale training-data pipeline.

Every operator takes DataFrames and returns DataFrames; the registered queries
(``queries.py``) derive their digest columns from those results. Row-wise work
runs as Arrow functions over record batches, everything that crosses rows is a
Spark shuffle, and PII is DataFrame expressions only.
"""
