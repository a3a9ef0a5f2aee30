"""As-of and interval joins against loops over all pairs; skew and plans."""

import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import temporal as tm


def as_of(left, right, strict):
    out = []
    for g, t, name in left:
        before = [(rt, v) for rg, rt, v in right
                  if None not in (rg, rt, g, t) and rg == g and (rt < t or (rt == t and not strict))]
        out.append((g, t, name, max(before)[1] if before else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("strict", [True, False])
def test_as_of_join_matches_a_loop(spark, strict):
    rng = random.Random(strict)
    key = lambda: rng.choice([1, 1, 1, 2, 3, None])
    time = lambda: rng.choice([None, *range(12)])
    left = [(key(), time(), f"l{i}") for i in range(120)] + [(7, 5, "alone"), (7, 5, "alone")]
    right = [(key(), time(), rng.randrange(50)) for _ in range(60)]
    lf = spark.createDataFrame(left, "g int, t int, name string").repartition(4)
    rf = spark.createDataFrame(right, "g int, t int, v int").repartition(3)
    got = tm.as_of_join(lf, rf, ["g"], "t", ["v"], strict)
    assert got.columns == ["g", "t", "name", "v"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == as_of(left, right, strict)
    empty = tm.as_of_join(lf, rf.limit(0), ["g"], "t", ["v"], strict)
    assert empty.count() == len(left) and empty.filter("v is not null").isEmpty()
    assert tm.as_of_join(lf.limit(0), rf, ["g"], "t", ["v"], strict).isEmpty()


def test_a_hot_customer_is_split_over_partitions(spark):
    """One customer with most rows: no window group holds more than one range partition of it."""
    left = spark.range(4000).select(F.lit(1).alias("g"), "id", (F.col("id") * 3).alias("t"))
    left = left.unionByName(spark.range(1000).select((F.col("id") + 2).cast("int").alias("g"), "id",
                                                     F.col("id").alias("t")))
    right = spark.range(0, 12000, 500).select(F.lit(1).alias("g"), F.col("id").alias("t"),
                                              F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = tm.as_of_join(left, right, ["g"], "t", ["v"])
        rows = got.filter("g = 1").select("t", "v").collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        laid = left.select("g", "t").repartitionByRange("g", "t").groupBy(
            "g", F.spark_partition_id().alias("part")).count()
        hot = [r["count"] for r in laid.collect() if r.g == 1]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert all(r.v == (None if r.t == 0 else (r.t - 1) // 500 * 500) for r in rows)
    assert len(hot) > 2 and max(hot) < 2500
    assert "part" in plan and "CartesianProduct" not in plan


def test_interval_join_matches_a_loop(spark):
    rng = random.Random(5)
    points = [(rng.choice([1, 2, None]), rng.choice([None, *range(-40, 200)]), i) for i in range(150)]
    spans = [(rng.choice([1, 2, None]), a := rng.randrange(-50, 190),
              rng.choice([None, a - 2, a, a + 3, a + 64, a + 10_000]), i) for i in range(80)]
    pf = spark.createDataFrame(points, "g int, at long, p int")
    sf = spark.createDataFrame(spans, "g int, lo long, hi long, s int")
    got = tm.interval_join(pf, sf, ["g"], "at", "lo", "hi")
    want = sorted((g, at, p, lo, hi, s) for g, at, p in points for sg, lo, hi, s in spans
                  if None not in (g, at, hi) and g == sg and lo <= at <= hi)
    assert got.columns == ["g", "at", "p", "lo", "hi", "s"]
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 300
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert tm.interval_join(pf.limit(0), sf, ["g"], "at", "lo", "hi").isEmpty()
    assert tm.interval_join(pf, sf.limit(0), ["g"], "at", "lo", "hi").isEmpty()


def test_long_intervals_are_two_rows_at_most(spark):
    spans = spark.createDataFrame([(1, 0, 10 ** 12), (1, 5, 5), (1, -7, 900)], "g int, lo long, hi long")
    level = tm._level(F.col("hi") - F.col("lo"))
    width = F.pow(F.lit(2.0), level)
    n = spans.select((F.floor(F.col("hi") / width) - F.floor(F.col("lo") / width) + 1).alias("n"))
    assert max(r.n for r in n.collect()) <= 2
