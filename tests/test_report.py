"""Report helpers against numpy, and skew-safe positions against row_number."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.functions.ranking import position_in_groups
from basketry.operators import report as rep


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(7)
    vals = np.round(rng.gamma(2.0, 1.5, 500), 3)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "user_id bigint, score double")
    return df, vals


def test_histogram_matches_numpy(sample):
    df, vals = sample
    got = sorted(rep.histogram(df, "score", 40).collect(), key=lambda r: r["bin"])
    dens, edges = np.histogram(vals, bins=40, density=True)
    counts, _ = np.histogram(vals, bins=40)
    assert [r["count"] for r in got] == counts.tolist()
    assert [r["density"] for r in got] == pytest.approx(dens.tolist(), abs=1e-6)
    assert [r["bin_lo"] for r in got] == pytest.approx(edges[:-1].tolist(), abs=1e-6)


def test_kde_matches_formula(sample):
    df, vals = sample
    got = sorted(rep.kde_curve(df, "score", 50, 0.3).collect(), key=lambda r: r["point"])
    h = 0.3 * np.std(vals, ddof=1)
    xs = np.linspace(vals.min(), vals.max(), 50)
    expect = [np.exp(-0.5 * ((x - vals) / h) ** 2).sum() / (len(vals) * h * math.sqrt(2 * math.pi))
              for x in xs]
    assert [r["density"] for r in got] == pytest.approx(expect, abs=2e-6)


def test_exact_median(sample):
    df, vals = sample
    med = rep.exact_median(df, "score", "user_id").first()["median"]
    assert med == pytest.approx(float(np.median(vals)))
    odd = df.filter("user_id < 99")
    assert rep.exact_median(odd, "score", "user_id").first()["median"] == \
        pytest.approx(float(np.median(vals[:99])))


def test_position_in_groups_equals_row_number(spark):
    # one hot group holding a third of the rows
    rows = [(0 if i % 3 == 0 else i % 50, (i * 7919) % 10007, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g bigint, o bigint, id bigint")
    ours = position_in_groups(df, ["g"], ["o", "id"], "pos", num_partitions=7)
    ref = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("o", "id")))
    assert ours.select("g", "o", "id", "pos").exceptAll(ref.select("g", "o", "id", "pos")).count() == 0
    glob = position_in_groups(df, [], ["id"], "pos", num_partitions=5)
    assert glob.filter(F.col("pos") != F.col("id") + 1).count() == 0


def test_metric_snapshot_middle_row(spark):
    s = spark.createDataFrame([(5, 0.1, 0.1, 0.1, 0.1, 3), (20, 0.3, 0.3, 0.3, 0.3, 3),
                               (50, 0.5, 0.5, 0.5, 0.5, 3)],
                              "k bigint, ndcg double, mrr double, recall double, precision double, n_users bigint")
    assert [r["k"] for r in rep.metric_snapshot(s, 10).collect()] == [20]
    assert [r["k"] for r in rep.metric_snapshot(s, 50).collect()] == [50]
