"""Driver contract, golden evaluation summary and streaming = batch."""

import pytest

import __spark_entry__ as entry
from basketry.plans import catalog as cat
from tests.conftest import SF001, SF01

# FIXTURES golden summary: brands rules sf0.01, top-20 rule recommendations.
GOLDEN = {5: (0.574602, 0.682827, 0.633716, 0.453981, 1482),
          10: (0.731369, 0.689206, 0.961876, 0.336370, 1482),
          20: (0.744838, 0.689555, 1.000000, 0.172874, 1482)}


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["k", "ndcg", "mrr", "recall", "precision", "n_users"]
    assert sorted(r["k"] for r in rows) == [5, 10, 20]


def test_every_oracle_has_a_query():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 70
    for name in qs:
        assert callable(qs[name])


def test_golden_summary(spark):
    got = {r["k"]: r for r in cat.q_eval_summary(spark, SF01).collect()}
    for k, (ndcg, mrr, rec, prec, n) in GOLDEN.items():
        r = got[k]
        assert (r["ndcg"], r["mrr"], r["recall"], r["precision"], r["n_users"]) == \
            pytest.approx((ndcg, mrr, rec, prec, n), abs=1e-6)


def test_stream_equals_batch(spark):
    streamed = cat.q_stream_rule_recommend(spark, SF001)
    batch = cat.q_rule_recommend_basket(spark, SF001)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0
