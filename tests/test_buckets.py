"""Bucketed tables, the table-function recommender and the median by selection."""

import random
import statistics

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.operators import metrics as met
from basketry.operators import recommender as rec
from basketry.operators import report as rep
from basketry.operators import rules as rl
from basketry.session import scratch_dir
from basketry.sources import buckets as bk


def written(spark, name, rows, schema):
    path = scratch_dir(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    return bk.write_bucketed(spark.createDataFrame(rows, schema), table, path), table


def exchanges(df):
    """Exchanges of the executed plan other than broadcasts."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    # User 0 holds a fifth of the lines.
    lines = {(0 if rng.random() < 0.2 else rng.randrange(1, 60), rng.randrange(400))
             for _ in range(3000)}
    truth = {(u, rng.randrange(400)) for u in range(60) for _ in range(4)}
    preds = [(u, k + 1, p, 1.0 / (k + 1)) for u in range(60)
             for k, p in enumerate(rng.sample(range(400), 20))]
    frames = {"histories": (sorted(lines), "user_id bigint, product_id bigint"),
              "truth": (sorted(truth), "user_id bigint, product_id bigint"),
              "predictions": (preds, "user_id bigint, rank bigint, product_id bigint, score double")}
    plain = {k: spark.createDataFrame(*v) for k, v in frames.items()}
    return plain, {k: written(spark, k, *v)[0] for k, v in frames.items()}


def test_bucket_spec(spark):
    _, name = written(spark, "spec", [(i, i) for i in range(50)], "user_id bigint, product_id bigint")
    assert bk.bucket_spec(spark, name) == (8, ["user_id"])
    empty, name = written(spark, "none", [], "user_id bigint, product_id bigint")
    assert empty.isEmpty()


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_scoring_without_exchange(spark, tables):
    plain, bucketed = tables
    rules = spark.createDataFrame(
        [(f"{a}>{c}", a, c, 0.1, 0.3 + (sum(a) % 7) / 10, 1.5)
         for a, c in [([i], [i + 1]) for i in range(0, 300, 3)] + [([i, i + 5], [i + 2, i + 9]) for i in range(0, 300, 2)]],
        "rule_id string, antecedent array<bigint>, consequent array<bigint>, support double,"
        "confidence double, lift double")
    weights = rl.scoring_weights(rules)
    top = lambda t: rl.top_n(rl.rule_scores(t["histories"], rules, weights=weights), 5)
    assert exchanges(top(bucketed)) == 0
    assert not top(plain).isEmpty() and same(top(plain), top(bucketed))


def test_metrics_and_report_without_exchange(tables):
    plain, bucketed = tables
    per_user = lambda t: met.per_user_metrics(t["predictions"], t["truth"])
    report = lambda t: rep.user_report(t["predictions"], t["histories"], t["truth"])
    for make in (per_user, report):
        assert exchanges(make(bucketed)) == 0
        assert exchanges(make(plain)) > 0
        assert same(make(plain), make(bucketed))


def test_any_callable_recommends(spark):
    rows = [(u, p, float((u * 7 + p * 3) % 5)) for u in range(9) for p in range(u)]
    scored = spark.createDataFrame(rows, "user_id bigint, product_id bigint, score double")
    got = rec.recommend_by(scored.repartition(4), rec.best_scores, 3)
    assert same(got, rl.top_n(scored, 3).select(got.columns))

    def newest(rows, n):   # another rule, which also answers with more than n
        return pa.table({"product_id": rows.column("product_id").to_numpy()[::-1].copy(),
                         "score": [1] * len(rows)})
    ranks = rec.recommend_by(scored.coalesce(1).orderBy("user_id", "product_id"), newest, 2)
    assert ranks.groupBy("user_id").count().filter("count > 2").isEmpty()
    assert ranks.select("user_id").distinct().count() == 8
    assert rec.recommend_by(scored.limit(0), rec.best_scores, 3).isEmpty()


def test_a_user_of_many_batches(spark):
    hot = spark.range(25_000).select(F.lit("u").alias("user_id"), F.col("id").alias("product_id"),
                                     (F.col("id") % 997).cast("double").alias("score"))
    got = rec.recommend_by(hot, rec.best_scores, 2).collect()
    assert [(r.user_id, r["rank"], r.product_id) for r in got] == [("u", 1, 996), ("u", 2, 1993)]


CASES = {
    "odd": [3.0, 1.0, 2.0], "even": [4.0, 1.0, 2.0, 3.5], "one": [7.25], "ties": [2.0] * 9 + [1.0] * 3,
    "signs": [-5.5, -0.0, 0.0, 3.0, -1e300, 1e300], "nulls": [None, 2.0, None, 8.0],
    "tiny": [5e-324, 1e-323, 1.5e-323, 2e-323, 1e-310], "wide": [1e-300, 1.0, 1e300, -1e308, 1.7e308],
    "near": [1.0 + i * 2.0 ** -52 for i in range(9)],
}


@pytest.mark.parametrize("case", CASES)
def test_median_cases(spark, case):
    df = spark.createDataFrame([(v,) for v in CASES[case]], "v double")
    want = statistics.median([v for v in CASES[case] if v is not None])
    assert rep.exact_median(df, "v").first()["median"] == want


def test_median_of_many_and_none(spark):
    rng = random.Random(11)
    values = [rng.lognormvariate(0, 6) * rng.choice([-1, 1]) for _ in range(5001)] + [0.5] * 2000
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    got = rep.exact_median(df, "v")
    assert got.first()["median"] == statistics.median(values)
    assert "rangepartitioning" not in got._jdf.queryExecution().toString()
    assert rep.exact_median(df.limit(0), "v").first()["median"] is None
    ends = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    assert rep.exact_median(ends, "v").first()["median"] == float("inf")
