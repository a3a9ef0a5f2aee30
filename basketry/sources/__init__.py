"""Sources (order-line readers, validation, profile) and sinks."""

from basketry.sources.readers import (
    check_columns,
    check_values,
    coerce_schema,
    dataset_profile,
    detect_format,
    load_order_lines,
    read_raw,
    validation_report,
)
from basketry.sources.sinks import (
    read_predictions,
    read_split,
    read_table,
    union_summaries,
    write_folds,
    write_predictions,
    write_table,
)

__all__ = [
    "check_columns", "check_values", "coerce_schema", "dataset_profile", "detect_format",
    "load_order_lines", "read_raw", "read_predictions", "read_split", "read_table",
    "union_summaries", "validation_report", "write_folds", "write_predictions", "write_table",
]
