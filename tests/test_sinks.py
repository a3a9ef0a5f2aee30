"""Split, prediction and summary sinks."""

import pytest

from basketry.schema import PREDICTION_SCHEMA
from basketry.sources import sinks


def test_folds_roundtrip_csv_and_parquet(spark, tmp_out):
    folds = spark.createDataFrame(
        [(1, 2, 3, "train"), (1, 4, 1, "train"), (1, 9, 7, "test")],
        "user_id bigint, product_id bigint, purchase_count bigint, fold string")
    for fmt in ("parquet", "csv"):
        path = sinks.write_folds(folds, f"{tmp_out}/split_{fmt}", fmt)
        tr, te = sinks.read_split(spark, path, fmt)
        assert sorted(map(tuple, tr.collect())) == [(1, 2, 3), (1, 4, 1)]
        assert [tuple(r) for r in te.collect()] == [(1, 9)]
        assert dict(tr.dtypes)["purchase_count"] == "bigint"


def test_folds_are_written_from_one_scan(spark, tmp_out):
    from basketry.operators.prepare import train_test_split
    spark.range(100).selectExpr("id % 5 as user_id", "id as product_id").write.parquet(f"{tmp_out}/lines")
    folds = train_test_split(spark.read.parquet(f"{tmp_out}/lines")).folds
    plan = folds._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_algorithms_keep_their_own_predictions(spark, tmp_out):
    rows = {a: [(u, 1, 10 * u + i, 0.5) for u in range(3)] for i, a in enumerate(("als", "fpgrowth"))}
    for a in ("als", "fpgrowth", "als"):      # the first writer again: replaced, not doubled
        path = sinks.write_predictions(spark.createDataFrame(rows[a], PREDICTION_SCHEMA),
                                       f"{tmp_out}/preds", a)
    got = {a: sorted(tuple(r)[:4] for r in sinks.read_predictions(spark, path, a).collect()) for a in rows}
    assert got == rows
    assert sinks.read_predictions(spark, path).count() == 6


def test_empty_predictions_keep_schema(spark, tmp_out):
    empty = spark.createDataFrame([], PREDICTION_SCHEMA)
    path = sinks.write_predictions(empty, f"{tmp_out}/preds", "als")
    back = sinks.read_predictions(spark, path, "als")
    assert back.count() == 0
    assert back.columns == ["user_id", "rank", "product_id", "score", "algorithm"]


def test_union_summaries(spark):
    s = spark.createDataFrame([(5, 0.1, 0.2, 0.3, 0.4, 7)],
                              "k bigint, ndcg double, mrr double, recall double, precision double, n_users bigint")
    out = sinks.union_summaries({"als": s, "fpgrowth": None})
    assert [r["algorithm"] for r in out.collect()] == ["als"]
    with pytest.raises(FileNotFoundError):
        sinks.union_summaries({"als": None})
    with pytest.raises(FileNotFoundError):
        sinks.spark_read(spark, "/nonexistent/basketry/summary")
