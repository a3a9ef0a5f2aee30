"""Train and infer runs: the two end-to-end jobs, each a chain of written tables.

``train`` — load and validate → split (written in one pass, read again by
everything below) → checks and statistics → encoders → ALS and rules fits
(saved) → per-user evaluation of both, stored, and from the stored table the
summary and report tables.

``infer`` — load saved models and split → cohort → batch top-N → predictions
table → evaluation on the cohort → inference-report tables.

All outputs are Parquet under ``out_dir`` (a shared folder on a cluster), and
every write overwrites, so a re-run after a lost executor or a failed job
replaces its outputs instead of duplicating them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from basketry.operators import encode as enc
from basketry.operators import metrics as met
from basketry.operators import predict as prd
from basketry.operators import prepare as prep
from basketry.operators import report as rep
from basketry.operators.als import ALSParams, FactorRecommender
from basketry.operators.encode import Encoder, ground_truth
from basketry.operators.rules import RuleModel, RuleParams
from basketry.sources import readers, sinks


@dataclass
class TrainConfig:
    test_ratio: float = 0.2
    seed: int = 42
    min_user_items: int = 10
    als: ALSParams = field(default_factory=ALSParams)
    rules: RuleParams = field(default_factory=RuleParams)
    ks: tuple = (5, 10, 20)
    eval_sample_size: int | None = None   # evaluate on a seeded sample of so many users
    fit_als: bool = True
    fit_rules: bool = True


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back."""
    return sinks.spark_read(spark, sinks.write_table(df, path))


def _evaluate(spark: SparkSession, recs: DataFrame, truth: DataFrame, ks, algorithm: str,
              stage: str, out: str) -> tuple[DataFrame, DataFrame]:
    """(summary, per_user), both stored; the recommendations are computed once."""
    per_user = _stored(spark, met.per_user_metrics(recs, truth, ks),
                       f"{out}/eval/{algorithm}_{stage}_per_user")
    summary = sinks.label_summary(met.summary(per_user, ks), algorithm, stage)
    return _stored(spark, summary, f"{out}/eval/{algorithm}_{stage}"), per_user


def train(spark: SparkSession, lines_path: str, out_dir: str,
          cfg: TrainConfig = TrainConfig(), lines: DataFrame | None = None) -> dict:
    """Run the training job; returns the paths it wrote and ``n_evaluated`` users.

    Given ``lines`` are checked like loaded ones.
    """
    out = out_dir.rstrip("/")
    if lines is None:
        lines = readers.load_order_lines(spark, lines_path)
    else:
        readers.check_columns(lines)
        readers.check_values(lines)
        lines = readers.coerce_schema(lines)
    _stored(spark, readers.dataset_profile(lines), f"{out}/stats/profile")
    split = prep.train_test_split(lines.select("user_id", "product_id"), cfg.test_ratio, cfg.seed,
                                  cfg.min_user_items)
    sinks.write_folds(split.folds, f"{out}/split")
    train_df, test_df = sinks.read_split(spark, f"{out}/split")
    prep.assert_disjoint(train_df, test_df)

    Encoder.fit(train_df).save(f"{out}/encoder")
    encoder = Encoder.load(spark, f"{out}/encoder")
    truth = _stored(spark, ground_truth(test_df, encoder), f"{out}/truth")
    weights = enc.confidence_weights(enc.encode_train(train_df, encoder), cfg.als.alpha)
    _stored(spark, enc.matrix_stats(enc.interaction_matrix(weights)), f"{out}/stats/matrix")
    _stored(spark, enc.ground_truth_stats(truth), f"{out}/stats/truth")
    folds = prep.folds_of(train_df, test_df)
    _stored(spark, prep.split_sanity(folds, truth), f"{out}/stats/split")
    users = _stored(spark, prep.eval_sample(truth, cfg.eval_sample_size, cfg.seed),
                    f"{out}/eval/users")
    paths = {"split": f"{out}/split", "encoder": f"{out}/encoder", "stats": f"{out}/stats",
             "n_evaluated": users.count()}
    judged = truth if cfg.eval_sample_size is None else met.restrict_truth(truth, users)
    kmax = max(cfg.ks)

    recs = {}
    if cfg.fit_als:
        als = FactorRecommender.fit(train_df, cfg.als, encoder=encoder)
        als.save(f"{out}/als")
        recs["als"] = als.recommend(users, kmax)
        paths["als"] = f"{out}/als"
    if cfg.fit_rules:
        rules = RuleModel.fit(train_df, cfg.rules)
        rules.save(f"{out}/rules")
        recs["fpgrowth"] = rules.recommend(train_df.join(users, "user_id", "left_semi"), kmax)
        paths["rules"] = f"{out}/rules"

    for algo, found in recs.items():
        summary, per_user = _evaluate(spark, found, judged, cfg.ks, algo, "train", out)
        paths[f"eval_{algo}"] = f"{out}/eval/{algo}_train"
        ndcg, report = met.per_user_ndcg(per_user, cfg.ks), f"{out}/report/{algo}"
        for name, table in (("ndcg_histogram", rep.ndcg_histogram(ndcg)),
                            ("ndcg_stats", rep.ndcg_stats(ndcg)),
                            ("ndcg_density", rep.ndcg_density(ndcg)),
                            ("metric_long", rep.metric_long(summary)),
                            ("metric_table", rep.metric_table(summary)),
                            ("metric_snapshot", rep.metric_snapshot(summary))):
            sinks.write_table(table, f"{report}_{name}")
    return paths


def infer(spark: SparkSession, out_dir: str, algorithm: str, n: int = 10,
          user_ids: DataFrame | None = None, ks=(5, 10, 20)) -> dict:
    """Run the inference job against a finished training run.

    The predictions table holds ``n`` rows a user; the evaluator's longer lists
    (up to the largest K) are a table of their own. Returns the paths,
    ``n_users`` (the cohort) and ``n_evaluated`` (those with truth).
    """
    prd.check_request(algorithm, n)
    out = out_dir.rstrip("/")
    train_df, test_df = sinks.read_split(spark, f"{out}/split")
    encoder = Encoder.load(spark, f"{out}/encoder")
    cohort = user_ids if user_ids is not None else prd.default_cohort(test_df, encoder)
    cohort = _stored(spark, cohort.select("user_id").distinct(), f"{out}/cohort/{algorithm}")
    longest = max(n, max(ks))
    if algorithm == "als":
        recs = FactorRecommender.load(spark, f"{out}/als").recommend(cohort, longest)
    else:
        model = RuleModel.load(spark, f"{out}/rules")
        recs = model.recommend(train_df.join(cohort, "user_id", "left_semi"), longest)
    recs = _stored(spark, recs, f"{out}/eval/{algorithm}_lists")
    pred_path = sinks.write_predictions(recs.filter(recs["rank"] <= n), f"{out}/predictions", algorithm)
    preds = sinks.read_predictions(spark, pred_path, algorithm).drop("algorithm")

    truth = ground_truth(test_df, encoder)
    judged = _stored(spark, met.restrict_truth(truth, cohort), f"{out}/eval/{algorithm}_truth")
    _evaluate(spark, recs, judged, ks, algorithm, "infer", out)
    rpt = f"{out}/report/{algorithm}"
    for name, table in (
            ("popularity", rep.rec_popularity(preds)),
            ("score_histogram", rep.score_histogram(preds)),
            ("score_density", rep.score_density(preds)),
            ("hits_histogram", rep.hits_histogram(rep.hits_per_user(preds, judged))),
            ("coverage", rep.catalog_coverage(preds, encoder.sizes())),
            ("recs_per_user", rep.recs_per_user_histogram(rep.recs_per_user(preds, cohort))),
            ("user_report", rep.user_report(preds, train_df, judged))):
        sinks.write_table(table, f"{rpt}_{name}")
    return {"predictions": pred_path, "eval_summary": f"{out}/eval/{algorithm}_infer", "report": rpt,
            "n_users": cohort.count(), "n_evaluated": judged.select("user_id").distinct().count()}


def combined_summaries(spark: SparkSession, out_dir: str) -> DataFrame:
    """Union of the stored train / infer summaries; missing ones are skipped."""
    out = out_dir.rstrip("/")
    found = {}
    for name in ("als_train", "als_infer", "fpgrowth_infer", "fpgrowth_train"):
        try:
            found[name] = sinks.spark_read(spark, f"{out}/eval/{name}")
        except FileNotFoundError:
            found[name] = None
    return sinks.union_summaries(found)
