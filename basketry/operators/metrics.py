"""Ranking metrics: NDCG, MRR, recall and precision at several K.

Input is any predictions frame ``(user_id, rank, product_id, score)`` — from
ALS, rules, or a file — and a long-form truth ``(user_id, product_id)``. Both
are merged by (user, product), then one aggregate per user yields every
metric at every K, and truth users without any hit score zero. The ideal DCG
is a higher-order ``aggregate`` over at most max(K) terms per row — no join
with a K table and no per-user Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.exprs import discount, r6
from basketry.functions.joins import dealt, union_on

DEFAULT_KS = (5, 10, 20)
TRUTH_PER_PART = 20_000


def normalise_ks(ks) -> list[int]:
    ks = sorted({int(k) for k in (ks or DEFAULT_KS)})
    if not ks:
        raise ValueError("at least one K is required")
    return ks


def per_user_metrics(predictions: DataFrame, truth: DataFrame, ks=DEFAULT_KS) -> DataFrame:
    """(user_id, k, ndcg, mrr, recall, precision) for every truth user and K.

    Users with truth but no (or failed) recommendations score 0 everywhere;
    users without truth are not evaluated.

    Plan: prediction rows (rank <= max K) and truth rows are unioned and
    merged by (user, product), so a hot user's rows spread over tasks (much truth is
    dealt by user first, into partitions of ``TRUTH_PER_PART`` of its rows); the
    per-user aggregate — one conditional sum / count / min per K — is combined
    in the tasks before its shuffle.
    """
    ks = normalise_ks(ks)
    kmax = max(ks)
    recs = (predictions.filter(F.col("rank") <= kmax)
                       .select("user_id", "product_id", F.col("rank").cast("bigint").alias("rank"),
                               F.lit(0).alias("rel")))
    rel = truth.select("user_id", "product_id", F.lit(None).cast("bigint").alias("rank"),
                       F.lit(1).alias("rel"))
    n_truth = truth.count()
    recs, rel = (dealt(x, "user_id", n_truth, TRUTH_PER_PART) for x in (recs, rel))
    merged = (union_on([recs, rel], "user_id").groupBy("_key", "product_id")
                  .agg(F.min("rank").alias("rank"), F.max("rel").alias("rel")))
    hit = F.col("rel") == 1
    aggs = [F.sum("rel").cast("bigint").alias("n_rel")]
    for k in ks:
        in_k = hit & (F.col("rank") <= k)
        aggs += [F.sum(F.when(in_k, discount(F.col("rank")))).alias(f"dcg_{k}"),
                 F.count(F.when(in_k, F.lit(1))).cast("bigint").alias(f"hit_{k}"),
                 F.min(F.when(in_k, F.col("rank"))).alias(f"first_{k}")]
    per_user = merged.groupBy("_key").agg(*aggs).filter(F.col("n_rel") > 0)
    per_k = F.array(*[F.struct(F.lit(k).cast("bigint").alias("k"),
                               F.col(f"dcg_{k}").alias("dcg"),
                               F.col(f"hit_{k}").alias("n_hit"),
                               F.col(f"first_{k}").alias("first_hit")) for k in ks])
    rows = per_user.select(F.col("_key").alias("user_id"), "n_rel", F.inline(per_k))

    ideal = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.least(F.col("n_rel"), F.col("k"))),
                        F.lit(0.0), lambda acc, i: acc + discount(i))
    n_hit = F.col("n_hit").cast("double")
    return rows.select(
        "user_id", "k",
        F.coalesce(F.col("dcg") / ideal, F.lit(0.0)).alias("ndcg"),
        F.coalesce(F.lit(1.0) / F.col("first_hit").cast("double"), F.lit(0.0)).alias("mrr"),
        (n_hit / F.col("n_rel").cast("double")).alias("recall"),
        (n_hit / F.col("k").cast("double")).alias("precision"))


def summary(per_user: DataFrame, ks=None) -> DataFrame:
    """Mean of each metric per K and the number of users (6 decimals).

    With ``ks``, every K has a row: NULL means and ``n_users`` 0 where no user
    was evaluated.
    """
    means = (per_user.groupBy("k")
                    .agg(r6(F.avg("ndcg")).alias("ndcg"), r6(F.avg("mrr")).alias("mrr"),
                         r6(F.avg("recall")).alias("recall"),
                         r6(F.avg("precision")).alias("precision"),
                         F.count(F.lit(1)).cast("bigint").alias("n_users")))
    if ks is None:
        return means
    grid = per_user.sparkSession.range(1).select(F.explode(F.array(
        *[F.lit(k).cast("bigint") for k in normalise_ks(ks)])).alias("k"))
    return grid.join(means, "k", "left").withColumn(
        "n_users", F.coalesce("n_users", F.lit(0).cast("bigint")))


def per_user_ndcg(per_user: DataFrame, ks=DEFAULT_KS) -> DataFrame:
    """NDCG@10 per user (NDCG at the largest K when 10 is not evaluated)."""
    ks = normalise_ks(ks)
    k = 10 if 10 in ks else max(ks)
    return per_user.filter(F.col("k") == k).select("user_id", "k", "ndcg")


def restrict_truth(truth: DataFrame, cohort: DataFrame) -> DataFrame:
    """Truth of the users that were asked for recommendations (I4)."""
    return truth.join(cohort.select("user_id").distinct(), "user_id", "left_semi")


def evaluate(predictions: DataFrame, truth: DataFrame, ks=DEFAULT_KS,
             users: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(summary, per_user). ``users`` optionally restricts the cohort first
    (a sample from ``prepare.eval_sample`` or an inference cohort)."""
    if users is not None:
        truth = restrict_truth(truth, users)
    per_user = per_user_metrics(predictions, truth, ks)
    return summary(per_user, ks), per_user
