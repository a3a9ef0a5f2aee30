"""Hold-out split invariants and the fixture's known counts."""

from pyspark.sql import functions as F

from basketry.operators.prepare import assign_folds, purchase_frequency, train_test_split
from basketry.plans.fixtures import line_pairs
from tests.conftest import SF01


def _user_lines(spark, sizes):
    rows = [(u, p) for u, n in sizes.items() for p in range(n)]
    return spark.createDataFrame(rows, "user_id bigint, product_id bigint")


def test_test_size_formula(spark):
    lines = _user_lines(spark, {1: 10, 2: 14, 3: 4, 4: 1})
    folds = assign_folds(purchase_frequency(lines), 0.2, 42, min_user_items=1)
    got = {(r["user_id"], r["fold"]): r["n"] for r in
           folds.groupBy("user_id", "fold").agg(F.count("*").alias("n")).collect()}
    assert got[(1, "test")] == 2 and got[(1, "train")] == 8
    assert got[(2, "test")] == 2 and got[(2, "train")] == 12
    assert got[(3, "test")] == 1 and got[(3, "train")] == 3
    assert got[(4, "test")] == 1 and (4, "train") not in got


def test_active_filter_and_duplicates(spark):
    lines = _user_lines(spark, {1: 10, 2: 9}).unionByName(_user_lines(spark, {1: 3}))
    split = train_test_split(lines, min_user_items=10)
    assert {r["user_id"] for r in split.folds.select("user_id").distinct().collect()} == {1}
    counts = {r["product_id"]: r["purchase_count"] for r in split.folds.collect()}
    assert counts[0] == 2 and counts[5] == 1


def test_fixture_counts_and_invariants(spark):
    split = train_test_split(line_pairs(spark, SF01), check=True)
    assert split.pairs.count() == 59391
    assert split.train.count() == 48070
    assert split.test.count() == 11256
    folds = split.folds
    assert folds.count() == 59326
    assert folds.select("user_id").distinct().count() == 1490
    # each user's test size is max(1, int(n * 0.2))
    per_user = folds.groupBy("user_id").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("fold") == "test", 1).otherwise(0)).alias("t"))
    bad = per_user.filter(F.col("t") != F.greatest(F.lit(1), F.floor(F.col("n") * 0.2)))
    assert bad.count() == 0


def test_split_is_deterministic(spark):
    a = train_test_split(line_pairs(spark, SF01)).test
    b = train_test_split(line_pairs(spark, SF01)).test
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_eval_sample_equals_plain_ordered_limit(spark):
    from basketry.functions.exprs import seeded_order_key
    from basketry.operators.prepare import eval_sample
    users = spark.range(5000).select(F.col("id").alias("user_id"))
    for n in (1, 37, 500, 4999, 5000, 6000):
        got = [r[0] for r in eval_sample(users, n, 42).collect()]
        ref = [r[0] for r in users.orderBy(seeded_order_key(42, "user_id"), "user_id")
                                  .limit(n).collect()]
        assert sorted(got) == sorted(ref)
        assert len(got) == min(n, 5000)
