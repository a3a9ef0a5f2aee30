"""Order-line readers: formats, validation errors, coercion."""

import json

import pytest
from pyspark.sql import functions as F

from basketry.schema import ORDER_LINE_SCHEMA, REQUIRED_COLUMNS
from basketry.sources import readers, sinks

ROW = {"order_id": 1, "user_id": 7, "product_id": 3, "aisle_id": 2, "department_id": 1,
       "order_number": 1, "order_dow": 0, "order_hour_of_day": 5,
       "days_since_prior_order": None, "add_to_cart_order": 1, "reordered": 0}


def _write_csv(path, rows, cols, sep=","):
    with open(path, "w") as fh:
        fh.write(sep.join(cols) + "\n")
        for r in rows:
            fh.write(sep.join("" if r[c] is None else str(r[c]) for c in cols) + "\n")


def test_csv_tsv_json_jsonl_roundtrip(spark, tmp_out):
    rows = [dict(ROW, order_id=i, product_id=i % 3, days_since_prior_order=float(i)) for i in range(5)]
    cols = REQUIRED_COLUMNS + ["extra"]
    for r in rows:
        r["extra"] = "x"
    _write_csv(f"{tmp_out}/a.csv", rows, cols)
    _write_csv(f"{tmp_out}/a.tsv", rows, cols, "\t")
    with open(f"{tmp_out}/a.json", "w") as fh:
        json.dump(rows, fh)
    with open(f"{tmp_out}/a.jsonl", "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))
    for suffix in ("csv", "tsv", "json", "jsonl"):
        df = readers.load_order_lines(spark, f"{tmp_out}/a.{suffix}")
        got = sorted(r["order_id"] for r in df.collect())
        assert got == list(range(5)), suffix
        assert dict(df.dtypes)["user_id"] == "bigint"
        assert dict(df.dtypes)["days_since_prior_order"] == "double"
    assert "extra" in readers.load_order_lines(spark, f"{tmp_out}/a.csv").columns


def test_missing_column(spark):
    df = spark.createDataFrame([(1, 2)], "user_id bigint, product_id bigint")
    with pytest.raises(ValueError, match="order_id"):
        readers.check_columns(df)


FORMATS = ("parquet", "csv", "tsv", "json", "jsonl")


def _write(spark, path, rows, fmt):
    """Rows of text (or None), so that any fault can be written in any format."""
    cols = list(rows[0])
    schema = ", ".join(f"{c} string" for c in cols)
    df = spark.createDataFrame([tuple(None if r[c] is None else str(r[c]) for c in cols)
                                for r in rows], schema)
    if fmt in ("csv", "tsv"):
        _write_csv(path, rows, cols, "\t" if fmt == "tsv" else ",")
    elif fmt == "parquet":
        df.write.parquet(path)
    else:
        with open(path, "w") as fh:
            fh.write(json.dumps(rows) if fmt == "json" else "\n".join(map(json.dumps, rows)))
    return path


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("fmt", FORMATS)
@pytest.mark.parametrize("column,value", [("order_number", "abc"), ("reordered", None),
                                          ("user_id", "xyz"), ("days_since_prior_order", "soon")])
def test_fault_in_any_column_fails_at_load(spark, tmp_out, fmt, ansi, column, value):
    rows = [dict(ROW, order_id=i, days_since_prior_order=1.0) for i in range(3)]
    rows[1][column] = value
    path = _write(spark, f"{tmp_out}/lines.{fmt}", rows, fmt)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(ValueError, match=column):
            readers.load_order_lines(spark, path)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("fmt", FORMATS)
def test_train_job_validates_unused_columns(spark, tmp_out, fmt):
    from basketry.plans import workflows as wf
    path = _write(spark, f"{tmp_out}/lines.{fmt}", [dict(ROW), dict(ROW, aisle_id="x")], fmt)
    with pytest.raises(ValueError, match="aisle_id"):
        wf.train(spark, path, f"{tmp_out}/run")


@pytest.mark.parametrize("fmt", FORMATS)
def test_missing_key_fails_and_extras_stay(spark, tmp_out, fmt):
    rows = [dict(ROW, extra="x", days_since_prior_order=2.5), dict(ROW, extra="y")]
    good = readers.load_order_lines(spark, _write(spark, f"{tmp_out}/a.{fmt}", rows, fmt))
    assert sorted(r["extra"] for r in good.collect()) == ["x", "y"]
    for r in rows:
        del r["days_since_prior_order"]
    path = _write(spark, f"{tmp_out}/b.{fmt}", rows, fmt)
    with pytest.raises(ValueError, match="days_since_prior_order"):
        readers.load_order_lines(spark, path)


def test_whole_numbers_written_as_decimals(spark, tmp_out):
    path = _write(spark, f"{tmp_out}/a.json", [dict(ROW, user_id=3.0)], "json")
    assert readers.load_order_lines(spark, path).first()["user_id"] == 3
    path = _write(spark, f"{tmp_out}/b.csv", [dict(ROW, user_id="3.5")], "csv")
    with pytest.raises(ValueError, match="user_id: 0 missing, 1 unreadable"):
        readers.load_order_lines(spark, path)


def test_malformed_json_fails(spark, tmp_out):
    with open(f"{tmp_out}/a.jsonl", "w") as fh:
        fh.write(json.dumps(ROW) + "\n{broken\n")
    with pytest.raises(Exception):
        readers.load_order_lines(spark, f"{tmp_out}/a.jsonl").collect()


def test_json_documents_are_bounded(spark, tmp_out):
    import os
    df = spark.range(1000).select(F.col("id").alias("order_id"))
    path = sinks.write_json_document(df.repartition(2), f"{tmp_out}/doc.json", document_chars=500)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) > 20 and max(os.path.getsize(f"{path}/{f}") for f in files) < 1000
    back = spark.read.schema("order_id bigint").option("multiLine", True).json(path)
    assert sorted(r[0] for r in back.collect()) == list(range(1000))


def test_unknown_suffix_and_missing_path(spark, tmp_out):
    with pytest.raises(ValueError):
        readers.load_order_lines(spark, f"{tmp_out}/data.xlsx")
    with pytest.raises(FileNotFoundError):
        readers.load_order_lines(spark, f"{tmp_out}/nothing_here.parquet")


def test_validate_false_skips_checks(spark, tmp_out):
    spark.createDataFrame([(1, 2)], "user_id bigint, product_id bigint") \
        .write.parquet(f"{tmp_out}/pairs.parquet")
    df = readers.load_order_lines(spark, f"{tmp_out}/pairs.parquet", validate=False)
    assert df.columns == ["user_id", "product_id"]


def test_json_document_writer(spark, tmp_out):
    df = spark.range(10).select(F.col("id").alias("order_id"))
    sinks.write_json_document(df.repartition(3), f"{tmp_out}/doc.json")
    back = spark.read.schema("order_id bigint").option("multiLine", True).json(f"{tmp_out}/doc.json")
    assert sorted(r[0] for r in back.collect()) == list(range(10))


def test_profile(spark):
    df = spark.createDataFrame([tuple({**ROW, "user_id": u, "product_id": p}[c] for c in REQUIRED_COLUMNS)
                                for u, p in [(1, 1), (1, 2), (2, 2)]], ORDER_LINE_SCHEMA)
    r = readers.dataset_profile(readers.coerce_schema(df)).first()
    assert (r["n_rows"], r["n_users"], r["n_products"], r["n_columns"]) == (3, 2, 2, 11)


def test_many_lines_are_dealt_to_more_partitions(spark, monkeypatch):
    """The same order lines and pairs, in partitions that grow with the lines."""
    from basketry.plans import fixtures
    from tests.conftest import SF001
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for make in (fixtures.order_lines, fixtures.line_pairs):
        monkeypatch.undo()
        want = make(spark, SF001, "brand")
        monkeypatch.setattr(fixtures, "LINES_PER_PART", 300)
        got = make(spark, SF001, "brand")
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()
        parts = -(-fixtures.table(spark, SF001, "lineitem").count() // 300)
        assert parts > few and f", {parts})" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fmt, suffix", [("json", ".json"), ("jsonl", ".jsonl"), ("csv", ".csv"), ("tsv", ".tsv")])
def test_round_trips_write_compressed_text(spark, fmt, suffix):
    """Every line comes back from text that takes a small part of its characters on disk."""
    import gzip
    from pathlib import Path
    from basketry.plans import catalog
    rows = [tuple(i % (7 + j) for j in range(len(REQUIRED_COLUMNS))) for i in range(3000)]
    kinds = ", ".join(f"{c} {'double' if c in readers.FLOAT_COLUMNS else 'bigint'}" for c in REQUIRED_COLUMNS)
    lines = spark.createDataFrame([tuple(None if c in readers.FLOAT_COLUMNS and v == 0 else float(v)
                                         if c in readers.FLOAT_COLUMNS else v
                                         for c, v in zip(REQUIRED_COLUMNS, r)) for r in rows], kinds)
    path = catalog._written(spark, lines.repartition(2), fmt, suffix)
    back = readers.load_order_lines(spark, path).select(*REQUIRED_COLUMNS)
    assert sorted(map(str, back.collect())) == sorted(map(str, lines.collect()))
    held = [p.read_bytes() for p in Path(path.removeprefix("file:")).rglob("part-*")]
    assert held and sum(map(len, held)) < sum(len(gzip.decompress(h)) for h in held) / 2
