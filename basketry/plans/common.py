"""Shared building blocks of the registered queries.

The fixtures follow the test-data mapping: ``lines`` (part as product) for
sources, preparation, encoding and ALS; ``brands`` (brand number as product)
for rules and everything downstream.

Like the train and infer jobs, which write the split, the models and the
predictions once and read them back, the queries materialise those shared
intermediates once per Spark application: fitted models, and the split
folds, predictions and per-user metrics as ``checkpoint()`` tables in the
shared checkpoint folder. A checkpointed frame keeps its hash partitioning,
so plans downstream of the split still need no extra exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.operators.encode import Encoder, ground_truth
from basketry.operators.prepare import Split, train_test_split
from basketry.operators.rules import RuleModel, RuleParams
from basketry.plans.fixtures import line_pairs
from basketry.session import checkpoint_root

# Fixed parameters of the checked fixtures.
SPLIT = dict(test_ratio=0.2, seed=42, min_user_items=10)
BRAND_RULES = RuleParams(min_support=0.30, min_confidence=0.45, min_lift=1.0, max_len=3)
KS = (5, 10, 20)
TOP_N = 10

_MEMO: dict = {}


def _memo(spark: SparkSession, key: tuple, build):
    full = (spark.sparkContext.applicationId,) + key
    if full not in _MEMO:
        _MEMO[full] = build()
    return _MEMO[full]


def split(spark: SparkSession, sf_dir: str, item: str = "part") -> Split:
    def build():
        s = train_test_split(line_pairs(spark, sf_dir, item), **SPLIT)
        checkpoint_root(spark)
        return Split(folds=s.folds.checkpoint(eager=True), freq=s.freq)
    return _memo(spark, ("split", sf_dir, item), build)


def encoder(spark: SparkSession, sf_dir: str, item: str = "part") -> Encoder:
    return _memo(spark, ("encoder", sf_dir, item),
                 lambda: Encoder.fit(split(spark, sf_dir, item).train))


def truth(spark: SparkSession, sf_dir: str, item: str = "part") -> DataFrame:
    return ground_truth(split(spark, sf_dir, item).test, encoder(spark, sf_dir, item))


def brand_rules(spark: SparkSession, sf_dir: str) -> RuleModel:
    return _memo(spark, ("rules", sf_dir),
                 lambda: RuleModel.fit(split(spark, sf_dir, "brand").train, BRAND_RULES))


def brand_recs(spark: SparkSession, sf_dir: str, n: int = TOP_N) -> DataFrame:
    """Rule recommendations for every train basket of the brands fixture."""
    model = brand_rules(spark, sf_dir)
    return model.recommend(split(spark, sf_dir, "brand").train, n)


# Reference training configuration for ALS (factors, regularisation,
# iterations, alpha) — the registered ALS queries use it unchanged.
ALS_PARAMS = dict(factors=128, regularization=0.01, iterations=30, alpha=40.0, seed=42)


def als_model(spark: SparkSession, sf_dir: str):
    from basketry.operators.als import ALSParams, FactorRecommender
    return _memo(spark, ("als", sf_dir),
                 lambda: FactorRecommender.fit(split(spark, sf_dir).train, ALSParams(**ALS_PARAMS),
                                               encoder=encoder(spark, sf_dir)))


def small_als(spark: SparkSession, sf_dir: str):
    """A light ALS model on the brands fixture, for checks that need any fitted model."""
    from basketry.operators.als import ALSParams, FactorRecommender
    return _memo(spark, ("small_als", sf_dir),
                 lambda: FactorRecommender.fit(split(spark, sf_dir, "brand").train,
                                               ALSParams(factors=8, iterations=3),
                                               encoder=encoder(spark, sf_dir, "brand")))


def brand_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default inference cohort of the brands fixture: test users known to the encoder."""
    from basketry.operators.predict import default_cohort
    return default_cohort(split(spark, sf_dir, "brand").test, encoder(spark, sf_dir, "brand"))


def brand_predictions(spark: SparkSession, sf_dir: str, n: int = TOP_N) -> DataFrame:
    """Rule predictions for the default cohort (the inference output table)."""
    from basketry.operators.predict import recommend

    def build():
        preds = recommend("fpgrowth", brand_cohort(spark, sf_dir), n,
                          rules=brand_rules(spark, sf_dir),
                          history=split(spark, sf_dir, "brand").train)
        return preds.checkpoint(eager=True)
    return _memo(spark, ("predictions", sf_dir, n), build)


def brand_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user metrics of the top-max(K) rule lists (the evaluation table)."""
    from basketry.operators.metrics import per_user_metrics

    def build():
        recs = brand_recs(spark, sf_dir, max(KS))
        return per_user_metrics(recs, truth(spark, sf_dir, "brand"), KS).checkpoint(eager=True)
    return _memo(spark, ("per_user", sf_dir), build)
