"""Train and infer runs end to end on the smallest fixture."""

from basketry.operators.als import ALSParams
from basketry.operators.rules import RuleParams
from basketry.plans import workflows as wf
from basketry.plans.fixtures import order_lines
from tests.conftest import SF001


def test_train_then_infer(spark, tmp_out):
    lines = order_lines(spark, SF001, "brand")
    cfg = wf.TrainConfig(min_user_items=3, als=ALSParams(factors=4, iterations=2),
                         rules=RuleParams(min_support=0.3, min_confidence=0.45),
                         eval_sample_size=50)
    paths = wf.train(spark, "", tmp_out, cfg, lines=lines)
    assert {"split", "encoder", "als", "rules", "eval_als", "eval_fpgrowth"} <= set(paths)
    assert paths["n_evaluated"] == 50
    for name in ("profile", "matrix", "truth", "split"):
        assert spark.read.parquet(f"{tmp_out}/stats/{name}").count() > 0
    for algo in ("als", "fpgrowth"):
        assert spark.read.parquet(f"{tmp_out}/report/{algo}_ndcg_stats").first()["n_users"] == 50
        out = wf.infer(spark, tmp_out, algo, n=5)
        assert 0 < out["n_evaluated"] <= out["n_users"]
        summary = spark.read.parquet(out["eval_summary"]).collect()
        assert sorted(r["k"] for r in summary) == [5, 10, 20]
        assert spark.read.parquet(out["report"] + "_user_report").count() > 0
    both = spark.read.parquet(out["predictions"]).groupBy("algorithm").agg({"rank": "max"}).collect()
    assert {tuple(r) for r in both} == {("als", 5), ("fpgrowth", 5)}
    combined = wf.combined_summaries(spark, tmp_out)
    assert combined.select("algorithm", "stage").distinct().count() == 4


def test_bad_request(spark, tmp_out):
    import pytest
    with pytest.raises(ValueError):
        wf.infer(spark, tmp_out, "knn")
    with pytest.raises(ValueError):
        wf.infer(spark, tmp_out, "als", n=0)


def test_smoke_workload(spark, tmp_out):
    """200 users, 50 products, 5000 order lines: every step of both jobs, with its sizes."""
    import random
    from basketry.schema import REQUIRED_COLUMNS
    rnd = random.Random(0)
    rows = [(i, rnd.randint(1, 200), rnd.randint(1, 50), rnd.randint(1, 19), rnd.randint(1, 4),
             rnd.randint(1, 9), rnd.randint(0, 6), rnd.randint(0, 23), rnd.uniform(0, 30),
             rnd.randint(1, 19), rnd.randint(0, 1)) for i in range(5000)]
    spark.createDataFrame(rows, REQUIRED_COLUMNS).write.parquet(f"{tmp_out}/lines.parquet")
    own = {}
    for r in rows:
        own.setdefault(r[1], set()).add(r[2])
    active = {u: len(p) for u, p in own.items() if len(p) >= 10}
    n_test = sum(max(1, n // 5) for n in active.values())
    cfg = wf.TrainConfig(als=ALSParams(factors=8, iterations=2), ks=(5, 10), eval_sample_size=50,
                         rules=RuleParams(min_support=0.05, min_confidence=0.3))
    run = wf.train(spark, f"{tmp_out}/lines.parquet", f"{tmp_out}/run", cfg)
    folds = {r["fold"]: r["count"] for r in
             spark.read.parquet(f"{tmp_out}/run/split").groupBy("fold").count().collect()}
    assert folds == {"test": n_test, "train": sum(active.values()) - n_test}
    profile = spark.read.parquet(f"{tmp_out}/run/stats/profile").first()
    assert tuple(profile) == (5000, len(own), len({p for x in own.values() for p in x}), 11)
    matrix = spark.read.parquet(f"{tmp_out}/run/stats/matrix").first()
    assert (matrix["n_rows"], matrix["nnz"]) == (len(active), folds["train"])
    assert run["n_evaluated"] == 50
    batch = spark.createDataFrame([(u,) for u in sorted(active)[:30]], "user_id bigint")
    for algo in ("als", "fpgrowth"):
        out = wf.infer(spark, f"{tmp_out}/run", algo, n=10, user_ids=batch, ks=(5, 10))
        assert out["n_users"] == 30
        lists = spark.read.parquet(f"{out['predictions']}/algorithm={algo}").groupBy("user_id").count()
        sizes = {r["user_id"]: r["count"] for r in lists.collect()}
        assert set(sizes) <= set(sorted(active)[:30]) and max(sizes.values()) <= 10
        if algo == "als":
            assert set(sizes.values()) == {10} and len(sizes) == 30
        summary = {r["k"]: r for r in spark.read.parquet(out["eval_summary"]).collect()}
        assert set(summary) == {5, 10} and all(0 <= r["ndcg"] <= 1 for r in summary.values())


def test_defaults_cut_nothing():
    cfg = wf.TrainConfig()
    assert cfg.eval_sample_size is None and cfg.rules.max_items is None
