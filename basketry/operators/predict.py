"""Batch inference: cohort choice, algorithm switch, prediction rows, nesting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.encode import Encoder

ALGORITHMS = ("als", "fpgrowth")
MAX_N = 500


def default_cohort(test: DataFrame, encoder: Encoder) -> DataFrame:
    """Every test user known to the encoder (distinct user_id)."""
    return (test.select("user_id").distinct()
                .join(encoder.users.select("user_id"), "user_id", "left_semi"))


def check_request(algorithm: str, n: int) -> None:
    if algorithm not in ALGORITHMS:
        raise ValueError(f"Unknown algorithm {algorithm!r}; expected one of {ALGORITHMS}")
    if not 1 <= int(n) <= MAX_N:
        raise ValueError(f"n_recommendations must be in 1..{MAX_N}, got {n}")


def recommend(algorithm: str, cohort: DataFrame, n: int, *, als=None, rules=None,
              history: DataFrame | None = None, exclude_owned: bool = False) -> DataFrame:
    """(user_id, rank, product_id, score) from the chosen recommender.

    ``rules`` needs ``history`` (user_id, product_id); only cohort users'
    histories are scored.
    """
    check_request(algorithm, n)
    if algorithm == "als":
        if als is None:
            raise RuntimeError("ALS model is not fitted")
        return als.recommend(cohort, n, exclude_owned)
    if rules is None:
        raise RuntimeError("rule model is not fitted")
    if history is None:
        raise ValueError("rule recommendations need the users' histories")
    own = history.join(cohort.select("user_id").distinct(), "user_id", "left_semi")
    return rules.recommend(own, n)


def nested(predictions: DataFrame, key: str = "user_id") -> DataFrame:
    """(key, items ARRAY<STRUCT<rank, product_id, score>>) sorted by rank.

    Each list holds at most N entries (N ≤ 500), so the per-key group is bounded.
    """
    item = F.struct(F.col("rank"), F.col("product_id"), F.col("score"))
    return predictions.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("items"))
