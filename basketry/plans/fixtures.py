"""Order lines derived from the TPC-H-style test tables.

``lineitem ⋈ orders ⋈ part`` gives one row per order line with the eleven
required columns. ``item="part"`` uses the part key as product ("lines"
fixture); ``item="brand"`` uses the brand number ("brands" fixture, dense
enough for association rules).

Per-user order positions come from ``position_in_groups`` (range-partitioned,
so one very active customer is never a single task); the previous order is an
equi-join on ``(user, position - 1)``; ``reordered`` compares each line with
the first position of its (user, product) pair, an aggregate pre-combined map
side. Columns a query does not select are pruned before any of this runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.joins import dealt
from basketry.functions.ranking import position_in_groups
from basketry.schema import REQUIRED_COLUMNS


# Lines and orders meet in partitions of about this many lines.
LINES_PER_PART = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _product_expr(item: str):
    if item == "part":
        return F.col("l_partkey")
    if item == "brand":
        return F.substring("p_brand", 7, 16).cast("bigint")
    raise ValueError(f"unknown item kind {item!r}")


def line_pairs(spark: SparkSession, sf_dir: str, item: str = "part") -> DataFrame:
    """Just (user_id, product_id) per order line — what the split needs."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    n_lines = lines.count()
    lines = dealt(lines, "l_orderkey", n_lines, LINES_PER_PART)
    orders = dealt(orders, "o_orderkey", n_lines, LINES_PER_PART)
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    if item == "brand":
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        joined = joined.join(part, joined.l_partkey == part.p_partkey)
    return joined.select(F.col("o_custkey").alias("user_id"),
                         _product_expr(item).alias("product_id"))


def order_lines(spark: SparkSession, sf_dir: str, item: str = "part") -> DataFrame:
    """All eleven required columns, typed as the loader would produce them."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand")
    n_lines = lines.count()
    lines = dealt(lines, "l_orderkey", n_lines, LINES_PER_PART)
    orders = dealt(orders, "o_orderkey", n_lines, LINES_PER_PART)
    base = (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
                 .join(part, lines.l_partkey == part.p_partkey)
                 .select(F.col("o_orderkey").alias("order_id"),
                         F.col("o_custkey").alias("user_id"),
                         _product_expr(item).alias("product_id"),
                         F.col("p_size").cast("bigint").alias("aisle_id"),
                         F.substring("p_brand", 7, 16).cast("bigint").alias("department_id"),
                         F.to_date("o_orderdate").alias("order_date"),
                         F.col("l_linenumber").cast("bigint").alias("add_to_cart_order")))

    user_orders = base.select("user_id", "order_date", "order_id").distinct()
    numbered = position_in_groups(user_orders, ["user_id"], ["order_date", "order_id"],
                                  "order_number")
    prev = numbered.select(F.col("user_id"),
                           (F.col("order_number") + 1).alias("order_number"),
                           F.col("order_date").alias("prev_date"))
    numbered = numbered.join(prev, ["user_id", "order_number"], "left").select(
        "order_id", "order_number",
        F.datediff("order_date", "prev_date").cast("double").alias("days_since_prior_order"))

    lines_num = dealt(base.join(numbered, "order_id"), ["user_id", "product_id"], n_lines, LINES_PER_PART)
    first_seen = lines_num.groupBy("user_id", "product_id").agg(
        F.min("order_number").alias("first_order"))
    out = (lines_num.join(first_seen, ["user_id", "product_id"])
           .withColumns({
               "order_dow": (F.dayofweek("order_date") - 1).cast("bigint"),
               "order_hour_of_day": (F.col("order_id") % 24).cast("bigint"),
               "reordered": (F.col("order_number") > F.col("first_order")).cast("bigint"),
           }))
    return out.select(*REQUIRED_COLUMNS)


# DuckDB text of the same derivation, used by the oracle queries.
def order_lines_sql(item: str = "part") -> str:
    product = ("l.l_partkey" if item == "part"
               else "CAST(substr(p.p_brand, 7) AS BIGINT)")
    return f"""
base AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id, {product} AS product_id,
         CAST(p.p_size AS BIGINT) AS aisle_id,
         CAST(substr(p.p_brand, 7) AS BIGINT) AS department_id,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(l.l_linenumber AS BIGINT) AS add_to_cart_order
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
numbered AS (
  SELECT order_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY order_date, order_id) AS BIGINT)
           AS order_number,
         CAST(order_date - lag(order_date) OVER (PARTITION BY user_id ORDER BY order_date, order_id)
              AS DOUBLE) AS days_since_prior_order
  FROM (SELECT DISTINCT user_id, order_date, order_id FROM base)
),
lines_num AS (
  SELECT b.*, n.order_number, n.days_since_prior_order
  FROM base b JOIN numbered n USING (order_id)
),
order_lines AS (
  SELECT order_id, user_id, product_id, aisle_id, department_id, order_number,
         CAST(dayofweek(order_date) AS BIGINT) AS order_dow,
         CAST(order_id % 24 AS BIGINT) AS order_hour_of_day,
         days_since_prior_order, add_to_cart_order,
         CAST(order_number > min(order_number) OVER (PARTITION BY user_id, product_id) AS BIGINT)
           AS reordered
  FROM lines_num
)"""


def line_pairs_sql(item: str = "part") -> str:
    product = ("l.l_partkey" if item == "part"
               else "CAST(substr(p.p_brand, 7) AS BIGINT)")
    join_part = "" if item == "part" else "JOIN part p ON l.l_partkey = p.p_partkey"
    return f"""
lines AS (
  SELECT o.o_custkey AS user_id, {product} AS product_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey {join_part}
)"""
