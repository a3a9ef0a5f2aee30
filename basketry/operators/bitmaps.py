"""Bitmaps over row numbers: frequent itemsets by AND and popcount, mergeable distinct counts.

The miner gives every basket a number and every item one row per 256 baskets that
hold it: four longs of bits. Itemsets grow item by item: candidates come from the
frequent sets one smaller, their bits are the AND of two rows of a block, their
frequency the sum of bit counts. All of it is joins and aggregates of DataFrame
functions; no pattern is on the driver, and no task holds more than a block's rows of
a candidate.

A distinct count over dense numbers is a table of bitmaps (``bitmap_construct_agg``)
of 32,768 numbers each: exact, a few bytes a value, and two loads' tables merge by
``bitmap_or_agg`` without rereading either.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import checkpoint_root

WORDS = ("w0", "w1", "w2", "w3")
_PER_ROW = 64 * len(WORDS)


def _bit_rows(baskets: DataFrame) -> DataFrame:
    """(item, block, w0..w3): which baskets of a block hold the item."""
    cells = (baskets.select(F.monotonically_increasing_id().alias("no"), "items")
             .select("no", F.explode("items").alias("item"))
             .withColumn("word", F.floor((F.col("no") % _PER_ROW) / 64)))
    bit = F.expr("shiftleft(1L, cast(no % 64 as int))")
    return cells.groupBy("item", F.floor(F.col("no") / _PER_ROW).alias("block")).agg(*[
        F.coalesce(F.bit_or(F.when(F.col("word") == i, bit)), F.lit(0).cast("long")).alias(w)
        for i, w in enumerate(WORDS)])


def _frequency():
    return F.sum(reduce(lambda a, b: a + b, [F.bit_count(w) for w in WORDS])).cast("long")


def bitmap_itemsets(baskets: DataFrame, threshold: int, max_len: int) -> DataFrame:
    """(items, freq) of the itemsets up to ``max_len`` in ``threshold`` baskets at least.

    ``baskets``: rows with an array ``items`` of distinct products.
    """
    checkpoint_root(baskets.sparkSession)
    bits = _bit_rows(baskets).checkpoint(eager=True)
    single = bits.groupBy("item").agg(_frequency().alias("freq")).filter(F.col("freq") >= threshold)
    single = single.checkpoint(eager=True)
    items = bits.join(single.select("item"), "item", "left_semi").checkpoint(eager=True)
    found = [single.select(F.array("item").alias("items"), "freq")]
    rows = items.select(F.array("item").alias("items"), "block", *WORDS)
    right = items.select("item", "block", *[F.col(w).alias(f"r_{w}") for w in WORDS])
    for length in range(2, max_len + 1):
        last = found[-1]
        if length == 2:
            # Every pair of frequent items that meet in a block is a candidate.
            met = rows.join(right, "block").filter(F.col("item") > F.element_at("items", -1))
        else:
            # Two frequent sets that differ in their last item only.
            head = F.slice("items", 1, length - 2)
            left = last.select(head.alias("head"), "items", F.element_at("items", -1).alias("low"))
            other = last.select(head.alias("head"), F.element_at("items", -1).alias("item"))
            candidates = left.join(other, "head").filter(F.col("item") > F.col("low")).select(
                "items", "item")
            met = rows.join(candidates, "items").join(right, ["item", "block"])
        both = (met.select(F.concat("items", F.array("item")).alias("items"), "block", *[
            F.col(w).bitwiseAND(F.col(f"r_{w}")).alias(w) for w in WORDS])
            .filter(" or ".join(f"{w} != 0" for w in WORDS)))
        if length < max_len:
            both = both.checkpoint(eager=True)
        next_ = both.groupBy("items").agg(_frequency().alias("freq")).filter(
            F.col("freq") >= threshold).checkpoint(eager=True)
        found.append(next_)
        if length < max_len:
            if next_.isEmpty():
                break
            rows = both.join(next_.select("items"), "items", "left_semi")
    return reduce(DataFrame.unionByName, found)


# -- distinct counts ------------------------------------------------------------

def bitmap_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, bucket, map, n_rows): one load's mergeable profile of whole-number columns.

    ``n_rows`` stands in a row of its own (column null). Nulls are not counted.
    """
    parts = [df.select(F.lit(None).cast("string").alias("column"), F.lit(None).cast("long").alias("bucket"),
                       F.lit(None).cast("binary").alias("map")).groupBy("column", "bucket", "map")
             .agg(F.count(F.lit(1)).alias("n_rows"))]
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("value")) for c in cols])))
    maps = (cells.filter("value is not null")
            .groupBy("column", F.bitmap_bucket_number("value").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("map"))
            .withColumn("n_rows", F.lit(0).cast("long")))
    return parts[0].unionByName(maps)


def merge_profiles(profiles: list[DataFrame]) -> DataFrame:
    """The profile of all loads together."""
    return (reduce(DataFrame.unionByName, profiles).groupBy("column", "bucket")
            .agg(F.bitmap_or_agg("map").alias("map"), F.sum("n_rows").alias("n_rows"))
            .withColumn("map", F.when(F.col("column").isNotNull(), F.col("map"))))


def profile_counts(profile: DataFrame, cols: list[str]) -> DataFrame:
    """One row: n_rows and ``n_<column>`` distinct values."""
    distinct = [F.coalesce(F.sum(F.when(F.col("column") == c, F.bitmap_count("map"))), F.lit(0))
                .cast("long").alias(f"n_{c}") for c in cols]
    return profile.agg(F.sum("n_rows").cast("long").alias("n_rows"), *distinct)
