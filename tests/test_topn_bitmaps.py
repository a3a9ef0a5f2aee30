"""Bound-stopped top-N, the bitmap miner and bitmap profiles."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import bitmaps as bm
from basketry.operators import report as rep
from basketry.operators import rules as rl
from basketry.operators import topn


def factors(spark, n_users, n_items, f, seed, falling=False):
    rng = np.random.default_rng(seed)
    u, v = rng.normal(size=(n_users, f)), rng.normal(size=(n_items, f))
    if falling:
        v *= (0.98 ** np.arange(n_items))[:, None]
    u, v = u.astype(np.float32), v.astype(np.float32)
    owned = [sorted(rng.choice(n_items, rng.integers(0, 6), replace=False).tolist()) or None
             for _ in range(n_users)]
    users = spark.createDataFrame([(i, x.tolist(), o) for i, (x, o) in enumerate(zip(u, owned))],
                                  "user_idx int, features array<float>, owned array<int>")
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)],
                                  "id int, features array<float>")
    return u, v, owned, users, items


@pytest.mark.parametrize("falling, n", [(False, 5), (True, 5), (True, 400)])
def test_best_products_equal_the_full_product(spark, falling, n):
    u, v, owned, users, items = factors(spark, 40, 300, 6, n, falling)
    best = topn.best_products(users.repartition(3), items, n, block_items=16, chunk_users=7)
    got = {}
    for r in topn.ranked(best).orderBy("user_idx", "rank").collect():
        got.setdefault(r.user_idx, []).append((r.product_idx, r.score))
    for i, x in enumerate(u):
        s = v @ x
        s[owned[i] or []] = -np.inf
        order = [j for j in np.lexsort((np.arange(len(s)), -s)) if s[j] > -np.inf][:n]
        assert [p for p, _ in got[i]] == order
        assert np.allclose([s for _, s in got[i]], s[order], rtol=1e-5, atol=1e-5)
    share = topn.skipped_share(best)
    print("share of blocks skipped", round(share, 3))
    assert share > 0.5 if falling and n == 5 else share >= 0


def test_plan_has_no_nested_loop(spark):
    *_, users, items = factors(spark, 5, 40, 3, 1)
    blocks = topn.norm_blocks(items, 8)
    assert [r.n for r in blocks.select(F.size("ids").alias("n")).collect()] == [8] * 5
    norms = [r.norm for r in blocks.orderBy("block").collect()]
    assert norms == sorted(norms, reverse=True)
    for df in (blocks, topn.best_products(users, items, 3, 8)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_users_or_items(spark):
    *_, users, items = factors(spark, 5, 40, 3, 2)
    assert topn.ranked(topn.best_products(users.limit(0), items, 3)).isEmpty()
    none = topn.best_products(users, items.limit(0), 3)
    assert topn.ranked(none).isEmpty() and topn.skipped_share(none) == 0


def test_bitmap_miner_matches_the_others(spark):
    rng = random.Random(3)
    made = [sorted(rng.sample(range(40), rng.randrange(1, 9))) for _ in range(700)] + [[1, 2, 3]] * 90
    baskets = spark.createDataFrame([(i, b) for i, b in enumerate(made)],
                                    "user_id long, items array<bigint>").repartition(5)
    counts = Counter(c for b in made for k in (1, 2, 3, 4) for c in combinations(b, k))
    for support, longest in ((0.02, 3), (0.1, 4), (0.9, 3)):
        need = rl.min_count(support, len(made))
        got = {tuple(r["items"]): r["freq"] for r in rl.frequent_itemsets(
            baskets, len(made), support, longest, miner="bitmap").collect()}
        assert got == {c: f for c, f in counts.items() if f >= need and len(c) <= longest}
    other = rl.frequent_itemsets(baskets, len(made), 0.02, 3)
    mine = rl.frequent_itemsets(baskets, len(made), 0.02, 3, miner="bitmap")
    assert sorted(map(str, other.collect())) == sorted(map(str, mine.collect()))
    empty = spark.createDataFrame([], baskets.schema)
    assert rl.frequent_itemsets(empty, 0, 0.1, 3, miner="bitmap").isEmpty()
    with pytest.raises(ValueError):
        rl.frequent_itemsets(baskets, 10, 0.1, 3, miner="other")


def test_profiles_of_two_loads_merge(spark):
    a = spark.range(50_000).select((F.col("id") % 40_000).alias("user_id"), (-F.col("id")).alias("product_id"))
    b = spark.range(30_000, 90_000).select("id", F.lit(None).cast("long").alias("product_id")).withColumnRenamed(
        "id", "user_id")
    cols = ["user_id", "product_id"]
    one, other = bm.bitmap_profile(a, cols), bm.bitmap_profile(b, cols)
    both = bm.profile_counts(bm.merge_profiles([one, other]), cols).first()
    assert tuple(both) == (110_000, 90_000, 50_000)
    assert tuple(bm.profile_counts(one, cols).first()) == (50_000, 40_000, 50_000)
    # Merging a load with itself counts rows twice and values once.
    again = bm.profile_counts(bm.merge_profiles([one, one]), cols).first()
    assert tuple(again) == (100_000, 40_000, 50_000)
    nothing = bm.profile_counts(bm.bitmap_profile(a.limit(0), cols), cols).first()
    assert (nothing["n_user_id"], nothing["n_product_id"]) == (0, 0)


def test_rollup_tells_subtotals_from_nulls(spark):
    rows = [(1, 1, 10, 0), (1, 1, 10, 1), (1, None, 11, 0), (None, 2, 12, 1)]
    lines = spark.createDataFrame(
        rows, "department_id int, aisle_id int, product_id int, reordered int")
    df = rep.popularity_rollup(lines)
    got = {(r.department_id, r.aisle_id, r.product_id, r.level): (r.n_lines, r.n_reordered)
           for r in df.collect()}
    assert got[(None, None, None, 7)] == (4, 2) and got[(None, None, None, 3)] == (1, 1)
    assert got[(1, None, None, 3)] == (3, 1) and got[(1, None, None, 1)] == (1, 0)
    assert len(got) == 9 and rep.popularity_rollup(lines, 2).count() == 4
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" in plan
    assert rep.popularity_cube(lines, ["department_id", "aisle_id"]).count() == 3 + 3 + 2 + 1
