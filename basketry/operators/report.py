"""Tables behind the training and inference reports.

Curves first group their input to distinct (value, count) rows, checkpointed,
so an expensive input is read once; the few numbers they need of it (min, max,
n, variance) are one aggregate row. Histograms fill empty bins from
``spark.range(bins)``. Kernel densities add up a grid per task, vectorised,
and sum the tasks' grids. The exact median is selected by value bits in a few
aggregates, so no row is sorted or moved. The user report unions predictions, train and truth rows and shuffles
them once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.exprs import equal_width_bin, r6, round_half_up
from basketry.functions.joins import union_on
from basketry.session import checkpoint_root

METRICS = ("ndcg", "mrr", "recall", "precision")


# --------------------------------------------------------------- helpers --
def _weighted_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of ``col`` with their counts ``w``, checkpointed.

    The input (often a whole recommendation plan) is evaluated once; the
    statistics and bins below read this small table instead.
    """
    values = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    checkpoint_root(df.sparkSession)
    return values.groupBy("x").agg(F.count(F.lit(1)).alias("w")).checkpoint(eager=True)


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """(bin, bin_lo, bin_hi, count, density) over [min, max] of ``col``.

    Right edge inclusive; density = count / (n · width); a constant column
    spans [v - 0.5, v + 0.5]. Empty input gives no rows.
    """
    weighted = _weighted_values(df, col)
    st = weighted.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("w").alias("n")).first()
    schema = "bin bigint, bin_lo double, bin_hi double, count bigint, density double"
    if not st["n"]:
        return df.sparkSession.createDataFrame([], schema)
    lo, hi = (st["lo"], st["hi"]) if st["lo"] < st["hi"] else (st["lo"] - 0.5, st["hi"] + 0.5)
    width = (hi - lo) / float(bins)
    counts = (weighted.select(equal_width_bin(F.col("x"), F.lit(st["lo"]), F.lit(st["hi"]), bins)
                              .alias("bin"), "w")
                      .groupBy("bin").agg(F.sum("w").cast("bigint").alias("count")))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("bigint").alias("bin"))
    count = F.coalesce(F.col("count"), F.lit(0).cast("bigint"))
    return grid.join(counts, "bin", "left").select(
        "bin", r6(F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        r6(F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"), count.alias("count"),
        r6(count.cast("double") / (F.lit(float(st["n"])) * F.lit(width))).alias("density"))


def kde_curve(df: DataFrame, col: str, points: int = 300, bandwidth: float = 0.3,
              grid: tuple[float, float] | None = None) -> DataFrame:
    """Gaussian kernel density on an evenly spaced grid: (point, x, density).

    Kernel sd = ``bandwidth`` × sample sd; grid = [min, max] of the data unless
    given. Zero variance or fewer than two values give no rows. Each task adds
    its distinct values to one grid of ``points`` sums and passes that on.
    """
    weighted = _weighted_values(df, col)
    st = weighted.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("w").alias("n"),
                      (F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("mean")).first()
    empty = df.sparkSession.createDataFrame([], "point bigint, x double, density double")
    if (st["n"] or 0) < 2:
        return empty
    off = F.col("x") - F.lit(st["mean"])
    h = bandwidth * math.sqrt(weighted.agg(F.sum(F.col("w") * off * off)).first()[0] / (st["n"] - 1))
    if not h > 0:
        return empty
    lo, hi = grid or (st["lo"], st["hi"])
    at = lo + np.arange(points) * ((hi - lo) / float(points - 1))
    norm = st["n"] * h * math.sqrt(2.0 * math.pi)

    def masses(batches):
        total = np.zeros(points)
        for batch in batches:
            v, w = (batch.column(i).to_numpy() for i in (0, 1))
            for s in range(0, len(v), 4096):
                z = (at[:, None] - v[None, s:s + 4096]) / h
                total += np.exp(-0.5 * z * z) @ w[s:s + 4096].astype(float)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(points)), pa.array(at), pa.array(total)],
                                         ["point", "x", "mass"])

    curve = weighted.select("x", "w").mapInArrow(masses, "point bigint, x double, mass double")
    return (curve.groupBy("point").agg(F.max("x").alias("x"), F.sum("mass").alias("mass"))
            .select("point", r6("x").alias("x"), r6(F.col("mass") / F.lit(norm)).alias("density")))


_DIGIT = 4096   # bins of a selection pass


def _exponent(v):
    """Sign and binary exponent of a double as one number that never falls as ``v`` rises."""
    size = F.floor(F.log2(F.abs(v))).cast("bigint") + 1100
    inf = F.lit(float("inf"))
    return (F.when(v == 0, 0).when(F.isnan(v), 4000).when(v == inf, 3000).when(v == -inf, -3000)
             .when(v > 0, size).otherwise(-size))


def _select(values: DataFrame, rank: int) -> tuple[float, int]:
    """The value ``v`` at 1-based ``rank`` and the number of values up to it.

    First the values are counted by sign and exponent, then by twelve bits of
    what is left, always within the group that holds the rank: at most some
    4,200 counts a pass, five or six passes, and no row moves. Floating
    subtraction and division never change an order, so groups are ranges.
    """
    v, inside, before = F.col("v"), values, 0
    bin_of = _exponent(v)
    while True:
        counts = (inside.groupBy(bin_of.alias("bin"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                  .orderBy("bin").collect())
        for c in counts:
            if before + c["n"] >= rank:
                break
            before += c["n"]
        lo, hi = c["lo"], c["hi"]
        if lo == hi or lo != lo:
            return lo, before + c["n"]
        width = (hi - lo) / _DIGIT
        inside = values.filter(v.between(F.lit(lo), F.lit(hi)))
        # A width of zero: the range holds fewer doubles than a pass has bins.
        bin_of = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(_DIGIT)) if width else v


def exact_median(df: DataFrame, col: str, tie: str | None = None) -> DataFrame:
    """One row ``median`` — mean of the middle value(s), NULL without any; NaN is the greatest.

    The values are written once and selected, not sorted; ``tie`` (an order
    among equal values) makes no difference and is kept for callers.
    """
    checkpoint_root(df.sparkSession)
    return _median_row(df.select(F.col(col).cast("double").alias("v")).checkpoint(eager=True))


def _median_row(values: DataFrame) -> DataFrame:
    values = values.filter(F.col("v").isNotNull())
    n, median = values.count(), None
    if n:
        median, upto = _select(values, (n + 1) // 2)
        if upto < n // 2 + 1:   # the other middle value is the next greater one
            median = (median + values.filter(F.col("v") > F.lit(median)).agg(F.min("v")).first()[0]) / 2
    return values.sparkSession.range(1).select(F.lit(median).cast("double").alias("median"))


# ------------------------------------------------------ inference report --
def rec_popularity(predictions: DataFrame, top: int = 20) -> DataFrame:
    """The ``top`` most recommended products: (product_id, n_recommended)."""
    counts = predictions.groupBy("product_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_recommended"))
    return counts.orderBy(F.col("n_recommended").desc(), F.col("product_id")).limit(top)


def score_histogram(predictions: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(predictions, "score", bins)


def score_density(predictions: DataFrame, points: int = 300, bandwidth: float = 0.3) -> DataFrame:
    return kde_curve(predictions, "score", points, bandwidth)


def hits_per_user(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """|recs ∩ truth| for every recommended user that has truth (0 allowed)."""
    rel = truth.select("user_id", "product_id").distinct()
    users = predictions.select("user_id").distinct().join(
        rel.select("user_id").distinct(), "user_id", "left_semi")
    hits = (predictions.select("user_id", "product_id").distinct()
                       .join(rel, ["user_id", "product_id"], "left_semi")
                       .groupBy("user_id").agg(F.count(F.lit(1)).alias("hits")))
    return users.join(hits, "user_id", "left").select(
        "user_id", F.coalesce(F.col("hits"), F.lit(0)).cast("bigint").alias("hits"))


def hits_histogram(per_user_hits: DataFrame) -> DataFrame:
    """Users per integer hit count, with the overall mean on every row."""
    mean = per_user_hits.select(F.avg("hits")).scalar()
    return (per_user_hits.groupBy("hits").agg(F.count(F.lit(1)).cast("bigint").alias("n_users"))
                         .withColumn("mean_hits", F.round(mean, 6)))


def catalog_coverage(predictions: DataFrame, n_products: DataFrame) -> DataFrame:
    """Distinct recommended products, catalog size and their ratio."""
    catalog = n_products.select(F.col("n_products")).scalar()
    return predictions.agg(
        F.countDistinct("product_id").cast("bigint").alias("n_recommended")
    ).select("n_recommended", catalog.alias("n_catalog"),
             r6(F.col("n_recommended") / catalog).alias("coverage"))


def recs_per_user(predictions: DataFrame, cohort: DataFrame) -> DataFrame:
    """(user_id, n_recs) for every cohort user, zero included."""
    counts = predictions.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_recs"))
    return (cohort.select("user_id").distinct().join(counts, "user_id", "left")
                  .select("user_id", F.coalesce(F.col("n_recs"), F.lit(0)).cast("bigint")
                           .alias("n_recs")))


def recs_per_user_histogram(per_user: DataFrame, bins: int = 30) -> DataFrame:
    mean = per_user.select(F.avg("n_recs")).scalar()
    return histogram(per_user, "n_recs", bins).withColumn("mean_recs", F.round(mean, 6))


# ------------------------------------------------------- training report --
def ndcg_histogram(per_user_ndcg: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(per_user_ndcg, "ndcg", bins)


def ndcg_stats(per_user_ndcg: DataFrame) -> DataFrame:
    """n, mean and exact median of the per-user NDCG (input read once)."""
    checkpoint_root(per_user_ndcg.sparkSession)
    vals = per_user_ndcg.select("user_id", "ndcg").checkpoint(eager=True)
    med = _median_row(vals.select(F.col("ndcg").cast("double").alias("v")))
    agg = vals.agg(F.count(F.lit(1)).cast("bigint").alias("n_users"),
                   F.avg("ndcg").alias("mean"))
    return agg.select("n_users", r6("mean").alias("mean"),
                      r6(med.select("median").scalar()).alias("median"))


def ndcg_density(per_user_ndcg: DataFrame, points: int = 300, bandwidth: float = 0.3,
                 min_users: int = 10) -> DataFrame:
    """Density of NDCG on [0, 1]; only drawn when more than ``min_users`` values."""
    curve = kde_curve(per_user_ndcg, "ndcg", points, bandwidth, grid=(0.0, 1.0))
    return curve if per_user_ndcg.count() > min_users else curve.limit(0)


def metric_long(summary: DataFrame) -> DataFrame:
    """(k, metric, value) — the bar, line and heat-map panels."""
    return summary.unpivot(["k"], list(METRICS), "metric", "value")


def metric_snapshot(summary: DataFrame, k: int = 10) -> DataFrame:
    """The row at K = ``k``, else the middle row by K.

    The summary has one row per evaluated K, so the un-partitioned window
    runs over a handful of rows.
    """
    pos = F.row_number().over(Window.orderBy("k")) - 1
    n = summary.select(F.count(F.lit(1))).scalar()
    has_k = summary.filter(F.col("k") == k).select(F.count(F.lit(1))).scalar()
    ranked = summary.withColumn("pos", pos)
    pick = F.when(has_k > 0, F.col("k") == k).otherwise(F.col("pos") == F.floor(n / 2))
    return ranked.filter(pick).drop("pos")


def metric_table(summary: DataFrame) -> DataFrame:
    return summary.select("k", *[round_half_up(m, 4).alias(m) for m in METRICS], "n_users")


def user_report(predictions: DataFrame, train: DataFrame, truth: DataFrame) -> DataFrame:
    """Per recommendation: score (4 dp), the user's train and truth sizes,
    whether it is a hit, and the user's hits over the whole list.

    The three inputs are tagged, unioned and shuffled once by user. A user's
    rows are its list, its train products and its truth: at most the catalog.
    """
    def tagged(df, rank, score, is_train, is_truth):
        return df.select("user_id", "product_id", rank.cast("bigint").alias("rank"),
                         score.cast("double").alias("score"), F.lit(is_train).alias("is_train"),
                         F.lit(is_truth).alias("is_truth"))

    none = F.lit(None)
    rows = union_on([tagged(predictions, F.col("rank"), F.col("score"), 0, 0),
                     tagged(train, none, none, 1, 0),
                     tagged(truth.select("user_id", "product_id").distinct(), none, none, 0, 1)],
                    "user_id")
    user, pair = Window.partitionBy("_key"), Window.partitionBy("_key", "product_id")
    rows = (rows.withColumn("is_hit", F.max("is_truth").over(pair))
            .withColumns({"n_train_items": F.sum("is_train").over(user),
                          "n_truth": F.sum("is_truth").over(user),
                          "hits": F.sum(F.when(F.col("rank").isNotNull(), F.col("is_hit"))
                                        .otherwise(0)).over(user)}))
    return rows.filter(F.col("rank").isNotNull()).select(
        F.col("_key").alias("user_id"), "rank", "product_id", round_half_up("score", 4).alias("score"),
        *[F.col(c).cast("bigint").alias(c) for c in ("n_train_items", "n_truth", "is_hit", "hits")])


def popularity_rollup(lines: DataFrame, min_lines: int = 1) -> DataFrame:
    """Line counts by department, aisle and product with their subtotals, one shuffle.

    ``level`` is the grouping id (0: product, 1: aisle, 3: department, 7: all), which tells a
    subtotal from a null key. Groups under ``min_lines`` lines are left out.
    """
    keys = ["department_id", "aisle_id", "product_id"]
    return (lines.rollup(*keys)
            .agg(F.grouping_id().cast("bigint").alias("level"),
                 F.count(F.lit(1)).cast("bigint").alias("n_lines"),
                 F.sum("reordered").cast("bigint").alias("n_reordered"))
            .filter(F.col("n_lines") >= min_lines))


def popularity_cube(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Line counts by every subset of ``keys``, with the grouping id as ``level``."""
    return lines.cube(*keys).agg(F.grouping_id().cast("bigint").alias("level"),
                                 F.count(F.lit(1)).cast("bigint").alias("n_lines"),
                                 F.sum("reordered").cast("bigint").alias("n_reordered"))
