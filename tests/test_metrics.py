"""Ranking metrics against hand-computed values."""

import math

import pytest

from basketry.operators import metrics as met_module
from basketry.operators.metrics import per_user_metrics, summary


def _frames(spark, recs_by_user, truth_by_user):
    recs = [(u, r + 1, p, 1.0) for u, lst in recs_by_user.items() for r, p in enumerate(lst)]
    truth = [(u, p) for u, s in truth_by_user.items() for p in s]
    pred = spark.createDataFrame(recs, "user_id bigint, rank bigint, product_id bigint, score double")
    rel = spark.createDataFrame(truth, "user_id bigint, product_id bigint")
    return pred, rel


def _rows(df):
    return {(r["user_id"], r["k"]): r for r in df.collect()}


def test_hand_case(spark):
    pred, rel = _frames(spark, {1: [10, 20, 30, 40, 50]}, {1: {20, 50, 99}})
    got = _rows(per_user_metrics(pred, rel, [3, 5]))
    expect = {3: (0.296082, 0.5, 0.333333, 0.333333), 5: (0.477624, 0.5, 0.666667, 0.4)}
    for k, (ndcg, mrr, rec, prec) in expect.items():
        r = got[(1, k)]
        assert r["ndcg"] == pytest.approx(ndcg, abs=1e-6)
        assert r["mrr"] == pytest.approx(mrr, abs=1e-6)
        assert r["recall"] == pytest.approx(rec, abs=1e-6)
        assert r["precision"] == pytest.approx(prec, abs=1e-6)


def test_short_list_empty_and_miss(spark):
    # user 1: 2 recs, both hits, k=5 -> precision 2/5; user 2: no recs; user 3: no hit
    pred, rel = _frames(spark, {1: [7, 8], 3: [1, 2, 3]}, {1: {7, 8}, 2: {5}, 3: {9}})
    got = _rows(per_user_metrics(pred, rel, [5]))
    assert got[(1, 5)]["precision"] == pytest.approx(0.4)
    assert got[(1, 5)]["recall"] == pytest.approx(1.0)
    assert got[(1, 5)]["ndcg"] == pytest.approx(1.0)
    for u in (2, 3):
        r = got[(u, 5)]
        assert (r["ndcg"], r["mrr"], r["recall"], r["precision"]) == (0.0, 0.0, 0.0, 0.0)


def test_ks_sorted_deduped_and_summary(spark):
    pred, rel = _frames(spark, {1: [1, 2], 2: [3]}, {1: {2}, 2: {3}})
    per_user = per_user_metrics(pred, rel, [10, 5, 5])
    assert sorted({r["k"] for r in per_user.collect()}) == [5, 10]
    s = {r["k"]: r for r in summary(per_user).collect()}
    assert s[5]["n_users"] == 2
    # user 1: hit at rank 2 -> ndcg 1/log2(3); user 2: hit at rank 1 -> 1
    assert s[5]["ndcg"] == pytest.approx(round((1 / math.log2(3) + 1) / 2, 6))
    assert s[5]["mrr"] == pytest.approx(0.75)


def test_matches_mllib_ranking_metrics(spark):
    from pyspark.mllib.evaluation import RankingMetrics
    recs = {1: [1, 2, 3, 4], 2: [5, 6, 7, 8], 3: [9, 1, 2, 3]}
    truth = {1: {2, 4, 11}, 2: {8}, 3: {3, 9}}
    pred, rel = _frames(spark, recs, truth)
    ours = {r["k"]: r for r in summary(per_user_metrics(pred, rel, [2, 4])).collect()}
    pairs = spark.sparkContext.parallelize([(recs[u], list(truth[u])) for u in recs])
    rm = RankingMetrics(pairs)
    for k in (2, 4):
        assert ours[k]["ndcg"] == pytest.approx(rm.ndcgAt(k), abs=1e-6)
        assert ours[k]["precision"] == pytest.approx(rm.precisionAt(k), abs=1e-6)
        assert ours[k]["recall"] == pytest.approx(rm.recallAt(k), abs=1e-6)


def test_much_truth_is_dealt_by_user(spark, monkeypatch):
    recs = spark.createDataFrame([(u, k + 1, (u + k) % 9, 1.0) for u in range(30) for k in range(6)],
                                 "user_id bigint, rank bigint, product_id bigint, score double")
    truth = spark.createDataFrame([(u, p) for u in range(35) for p in range(3)],
                                  "user_id bigint, product_id bigint")
    want = met_module.per_user_metrics(recs, truth).collect()
    monkeypatch.setattr(met_module, "TRUTH_PER_PART", 2)
    got = met_module.per_user_metrics(recs, truth)
    assert sorted(got.collect()) == sorted(want)
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(user_id" in plan and "hashpartitioning(_key" not in plan
