"""The order-line contract: required columns and their types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The eleven required order-line columns, in the reference's order.
REQUIRED_COLUMNS = [
    "order_id",
    "user_id",
    "product_id",
    "aisle_id",
    "department_id",
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "days_since_prior_order",
    "add_to_cart_order",
    "reordered",
]

# Every required column but ``days_since_prior_order`` is a 64-bit integer.
FLOAT_COLUMNS = ["days_since_prior_order"]

ORDER_LINE_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType() if c in FLOAT_COLUMNS else T.LongType(), True)
     for c in REQUIRED_COLUMNS]
)

INTERACTION_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("rank", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("score", T.DoubleType(), True),
])

RULE_SCHEMA = T.StructType([
    T.StructField("rule_id", T.StringType(), False),
    T.StructField("antecedent", T.ArrayType(T.LongType(), False), False),
    T.StructField("consequent", T.ArrayType(T.LongType(), False), False),
    T.StructField("support", T.DoubleType(), False),
    T.StructField("confidence", T.DoubleType(), False),
    T.StructField("lift", T.DoubleType(), False),
])

ITEMSET_SCHEMA = T.StructType([
    T.StructField("items", T.ArrayType(T.LongType(), False), False),
    T.StructField("freq", T.LongType(), False),
    T.StructField("support", T.DoubleType(), False),
])


def require_columns(df: DataFrame, columns, what: str) -> None:
    """ValueError naming every one of ``columns`` that ``df`` lacks (metadata only)."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{what}: missing required columns {absent}")
