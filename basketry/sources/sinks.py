"""Table sinks and their readers: split folds, predictions, summaries.

Parquet is the default (typed, splittable, column-pruned on read); CSV is an
option for hand-off. Writes are whole-table overwrites so a retried job
replaces, never duplicates, its output.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.schema import INTERACTION_SCHEMA, PREDICTION_SCHEMA

TRAIN_SCHEMA = T.StructType(INTERACTION_SCHEMA.fields + [
    T.StructField("purchase_count", T.LongType(), False)])

SUMMARY_SCHEMA = T.StructType([
    T.StructField("k", T.LongType(), False),
    T.StructField("ndcg", T.DoubleType(), True),
    T.StructField("mrr", T.DoubleType(), True),
    T.StructField("recall", T.DoubleType(), True),
    T.StructField("precision", T.DoubleType(), True),
    T.StructField("n_users", T.LongType(), False),
])


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "parquet") -> DataFrame:
    """Read a table written by ``write_table`` with its declared schema."""
    if fmt == "csv":
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.schema(schema).parquet(path)


def write_folds(folds: DataFrame, path: str, fmt: str = "parquet") -> str:
    """(user_id, product_id, purchase_count, fold) as one table, written in one pass.

    A test pair keeps no purchase count.
    """
    count = F.when(F.col("fold") == "train", F.col("purchase_count"))
    return write_table(folds.select("user_id", "product_id", count.alias("purchase_count"), "fold"),
                       path, fmt, partition_by=["fold"])


def read_split(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Return (train, test); the ``fold`` filter prunes partitions on read."""
    schema = T.StructType(TRAIN_SCHEMA.fields[:2] + [
        T.StructField("purchase_count", T.LongType(), True),
        T.StructField("fold", T.StringType(), False)])
    df = read_table(spark, path, schema, fmt)
    train = df.filter(F.col("fold") == "train").select(
        "user_id", "product_id", F.col("purchase_count").cast("bigint").alias("purchase_count"))
    test = df.filter(F.col("fold") == "test").select("user_id", "product_id")
    return train, test


def write_predictions(predictions: DataFrame, path: str, algorithm: str,
                      fmt: str = "parquet") -> str:
    """Replace one algorithm's predictions; those of other algorithms stay.

    Each algorithm owns the folder ``algorithm=<name>`` of the table; an empty
    frame keeps its schema.
    """
    write_table(predictions.select(*PREDICTION_SCHEMA.fieldNames()),
                f"{path.rstrip('/')}/algorithm={algorithm}", fmt)
    return path


def read_predictions(spark: SparkSession, path: str, algorithm: str | None = None,
                     fmt: str = "parquet") -> DataFrame:
    """Predictions of every algorithm with its name, or of one."""
    schema = T.StructType(PREDICTION_SCHEMA.fields + [
        T.StructField("algorithm", T.StringType(), False)])
    df = read_table(spark, path, schema, fmt)
    if algorithm is not None:
        df = df.filter(F.col("algorithm") == algorithm)
    return df


def label_summary(summary: DataFrame, algorithm: str, stage: str) -> DataFrame:
    return summary.withColumns({"algorithm": F.lit(algorithm), "stage": F.lit(stage)})


def union_summaries(summaries: dict[str, DataFrame | None]) -> DataFrame:
    """Union labelled summaries; missing ones are skipped, none at all is an error."""
    present = [label_summary(df, algo, "eval") if "algorithm" not in df.columns else df
               for algo, df in summaries.items() if df is not None]
    if not present:
        raise FileNotFoundError("No evaluation summaries available")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def _documents(batches, limit: int):
    """Records as JSON arrays of about ``limit`` characters, one array per row."""
    import pyarrow as pa
    held, size = [], 0

    def document():
        return pa.RecordBatch.from_arrays([pa.array(["[" + ",".join(held) + "]"])], ["value"])

    for batch in batches:
        for rec in batch.column(0).to_pylist():
            held.append(rec)
            size += len(rec)
            if size >= limit:
                yield document()
                held, size = [], 0
    if held:
        yield document()


def write_json_document(df: DataFrame, path: str, document_chars: int = 4 << 20,
                        compression: str = "none") -> str:
    """One JSON array of records per output file (the multi-line ``.json`` form).

    Each task cuts its records into documents of bounded size and writes every
    document as a file of its own (a multi-line reader takes one value per
    file), so no task holds more than one document and every file can be read
    by a task of its own.
    """
    recs = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("rec"))
    docs = recs.mapInArrow(lambda batches: _documents(batches, document_chars), "value string")
    docs.write.mode("overwrite").option("maxRecordsPerFile", 1).option("compression", compression).text(path)
    return path


def spark_read(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet table written by this package; a missing path raises
    FileNotFoundError."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            raise FileNotFoundError(path) from exc
        raise
