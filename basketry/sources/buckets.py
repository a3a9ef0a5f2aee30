"""Tables bucketed by user in the catalog.

Histories, predictions and truth that are written in the same number of
buckets meet without a shuffle: the scan already delivers each user's rows in
one partition, so scoring, per-user metrics and the user report run from them
without an exchange before the per-user aggregate. A user's rows are its
distinct products, so a bucket is bounded by its users times the catalog;
choose ``buckets`` so that a bucket fits a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, name: str, path: str, key: str = "user_id",
                   buckets: int | None = None) -> DataFrame:
    """Write ``df`` under ``path`` as catalog table ``name``, bucketed and sorted by ``key``.

    Rows move once, so that every bucket is one file. ``buckets`` defaults to
    the session's shuffle partitions; tables that are to meet need the same number.
    An existing table of that name is replaced.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
       .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))
    return spark.table(name)


def bucket_spec(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """(number of buckets, bucket columns) of a catalog table; (0, []) if it has none."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    count = int(rows.get("Num Buckets", 0))
    columns = rows.get("Bucket Columns", "[]").strip("[]").replace("`", "")
    return count, [c.strip() for c in columns.split(",") if c.strip()]
