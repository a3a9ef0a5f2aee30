"""Interaction preparation: pairs, frequencies, active users, hold-out split.

One hash exchange on ``user_id`` feeds the active-user count, the per-user
order and the fold assignment. A user's group is its *distinct* products, so
its size is bounded by the catalog no matter how many lines the user has; the
line-level counting before it is a partial (map-side) aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.exprs import n_holdout, seeded_order_key
from basketry.functions.ranking import position_in_groups


def purchase_frequency(lines: DataFrame) -> DataFrame:
    """Rows per (user, product) over all lines: ``purchase_count``."""
    return (lines.groupBy("user_id", "product_id")
                 .agg(F.count(F.lit(1)).cast("bigint").alias("purchase_count")))


def distinct_pairs(lines: DataFrame) -> DataFrame:
    """Unique (user, product) pairs — the key set of the frequency table."""
    return purchase_frequency(lines).select("user_id", "product_id")


def active_pairs(freq: DataFrame, min_user_items: int = 10) -> DataFrame:
    """Keep users with at least ``min_user_items`` distinct products."""
    n = F.count(F.lit(1)).over(Window.partitionBy("user_id"))
    return (freq.withColumn("n_items", n.cast("bigint"))
                .filter(F.col("n_items") >= min_user_items))


def assign_folds(freq: DataFrame, test_ratio: float = 0.2, seed: int = 42,
                 min_user_items: int = 10) -> DataFrame:
    """Tag every active pair ``train`` or ``test``.

    Per user the products are ordered by ``md5('<seed>:<user>:<product>')``
    (ties by product); the last ``max(1, int(n * ratio))`` go to test. The
    purchase count rides along, so the train weight needs no join.
    """
    act = active_pairs(freq, min_user_items)
    order = Window.partitionBy("user_id").orderBy(
        seeded_order_key(seed, "user_id", "product_id"), F.col("product_id"))
    pos = F.row_number().over(order).cast("bigint")
    is_test = pos > F.col("n_items") - n_holdout(F.col("n_items"), test_ratio)
    return act.select("user_id", "product_id", "purchase_count",
                      F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("fold"))


@dataclass
class Split:
    """Lazy frames of one hold-out split."""

    folds: DataFrame   # user_id, product_id, purchase_count, fold
    freq: DataFrame    # user_id, product_id, purchase_count (all users)

    @property
    def train(self) -> DataFrame:
        return (self.folds.filter(F.col("fold") == "train")
                    .select("user_id", "product_id", "purchase_count"))

    @property
    def test(self) -> DataFrame:
        return self.folds.filter(F.col("fold") == "test").select("user_id", "product_id")

    @property
    def pairs(self) -> DataFrame:
        return self.freq.select("user_id", "product_id")


def train_test_split(lines: DataFrame, test_ratio: float = 0.2, seed: int = 42,
                     min_user_items: int = 10, check: bool = False) -> Split:
    """Per-user hold-out over distinct pairs of ``lines``."""
    freq = purchase_frequency(lines.select("user_id", "product_id"))
    split = Split(folds=assign_folds(freq, test_ratio, seed, min_user_items), freq=freq)
    if check:
        assert_disjoint(split.train, split.test)
    return split


def folds_of(train: DataFrame, test: DataFrame) -> DataFrame:
    """(user_id, product_id, fold) of two stored folds."""
    pair = ("user_id", "product_id")
    return train.select(*pair, F.lit("train").alias("fold")).unionByName(
        test.select(*pair, F.lit("test").alias("fold")))


def train_weighted(train: DataFrame, freq: DataFrame) -> DataFrame:
    """Attach purchase counts to bare train pairs; a missing count is 1."""
    return (train.select("user_id", "product_id")
                 .join(freq, ["user_id", "product_id"], "left")
                 .select("user_id", "product_id",
                         F.coalesce(F.col("purchase_count"), F.lit(1)).cast("bigint")
                          .alias("purchase_count")))


def fold_overlap(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: number of (user, product) pairs present in both folds."""
    both = train.select("user_id", "product_id").join(
        test.select("user_id", "product_id"), ["user_id", "product_id"], "left_semi")
    return both.agg(F.count(F.lit(1)).cast("bigint").alias("overlap_pairs"))


def assert_disjoint(train: DataFrame, test: DataFrame) -> None:
    n = fold_overlap(train, test).first()["overlap_pairs"]
    if n:
        raise AssertionError(f"the folds share {n} (user, product) pairs")


def eval_sample(users: DataFrame, sample_size: int | None = None, seed: int = 42) -> DataFrame:
    """``sample_size`` distinct users in a seeded md5 order; all of them if None.

    Positions come from ``position_in_groups`` (range-partitioned), so no task
    holds the sample or the user list, whatever the sizes.
    """
    distinct = users.select("user_id").distinct()
    if sample_size is None:
        return distinct
    keyed = distinct.withColumn("__key", seeded_order_key(seed, "user_id"))
    placed = position_in_groups(keyed, [], ["__key", "user_id"], "__place")
    return placed.filter(F.col("__place") <= int(sample_size)).select("user_id")


def split_sanity(folds: DataFrame, truth: DataFrame) -> DataFrame:
    """Coverage as (metric, value) rows: overlapping pairs, users per fold,
    truth users and mean truth size. Three small aggregates, unioned."""
    per_pair = (folds.groupBy("user_id", "product_id")
                     .agg(F.countDistinct("fold").alias("n_folds")))
    pair_stats = per_pair.agg(
        F.sum(F.when(F.col("n_folds") > 1, 1).otherwise(0)).cast("double").alias("overlap_pairs"))
    user_stats = folds.agg(
        F.countDistinct(F.when(F.col("fold") == "train", F.col("user_id"))).cast("double")
         .alias("train_users"),
        F.countDistinct(F.when(F.col("fold") == "test", F.col("user_id"))).cast("double")
         .alias("test_users"))
    truth_stats = (truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
                        .agg(F.count(F.lit(1)).cast("double").alias("truth_users"),
                             F.round(F.avg("n"), 6).alias("truth_mean_size")))
    parts = [df.unpivot([], df.columns, "metric", "value")
             for df in (pair_stats, user_stats, truth_stats)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
