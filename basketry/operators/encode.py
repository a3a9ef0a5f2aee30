"""Dense id dictionaries, confidence weights, interaction matrix, ground truth.

Dictionaries map raw ids to 0..n-1 in ascending id order. They are built with
``position_in_groups`` (range partitioning + per-partition offsets) rather
than a global ``row_number`` window, which would pull every id into one task.
The user×item "matrix" stays in long form; its transpose is a column swap.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.exprs import confidence
from basketry.functions.ranking import position_in_groups


def fit_index(ids: DataFrame, id_col: str, idx_col: str) -> DataFrame:
    """Distinct ``id_col`` values → ``idx_col`` INT, 0-based in ascending order.

    The fitted dictionary is written once (``checkpoint``) like any model
    artifact, so every later join reads a plain table that AQE can broadcast
    when small, instead of re-planning the ranking.
    """
    distinct = ids.select(id_col).distinct()
    pos = position_in_groups(distinct, [], [id_col], "__pos")
    return (pos.select(F.col(id_col), (F.col("__pos") - 1).cast("int").alias(idx_col))
               .checkpoint(eager=True))


@dataclass
class Encoder:
    """Fitted user and product dictionaries (checkpointed, so reusable)."""

    users: DataFrame      # user_id BIGINT, user_idx INT
    products: DataFrame   # product_id BIGINT, product_idx INT

    @classmethod
    def fit(cls, train: DataFrame) -> "Encoder":
        return cls(users=fit_index(train, "user_id", "user_idx"),
                   products=fit_index(train, "product_id", "product_idx"))

    def sizes(self) -> DataFrame:
        """One row: n_users, n_products (P10)."""
        spark = self.users.sparkSession
        return spark.range(1).select(
            self.users.agg(F.count(F.lit(1))).scalar().cast("bigint").alias("n_users"),
            self.products.agg(F.count(F.lit(1))).scalar().cast("bigint").alias("n_products"))

    def transform(self, df: DataFrame, strict: bool = True) -> DataFrame:
        """Attach user_idx and product_idx.

        ``strict`` keeps only known pairs (inner joins); otherwise unknown ids
        map to -1 (left joins). AQE broadcasts a dictionary when its runtime
        size is under the broadcast threshold and shuffles otherwise.
        """
        how = "inner" if strict else "left"
        out = df.join(self.users, "user_id", how).join(self.products, "product_id", how)
        if not strict:
            out = out.withColumns({
                "user_idx": F.coalesce(F.col("user_idx"), F.lit(-1)).cast("int"),
                "product_idx": F.coalesce(F.col("product_idx"), F.lit(-1)).cast("int"),
            })
        return out

    def decode_products(self, df: DataFrame) -> DataFrame:
        """product_idx → product_id (inner join on the index)."""
        return df.join(self.products, "product_idx").drop("product_idx")

    def decode_users(self, df: DataFrame) -> DataFrame:
        return df.join(self.users, "user_idx").drop("user_idx")

    def save(self, path: str) -> None:
        self.users.write.mode("overwrite").parquet(f"{path}/users")
        self.products.write.mode("overwrite").parquet(f"{path}/products")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Encoder":
        return cls(users=spark.read.parquet(f"{path}/users"),
                   products=spark.read.parquet(f"{path}/products"))


def encode_train(train: DataFrame, encoder: Encoder) -> DataFrame:
    """Train pairs + user_idx, product_idx (every train id is known)."""
    return encoder.transform(train, strict=True)


def confidence_weights(encoded: DataFrame, alpha: float = 40.0) -> DataFrame:
    """``confidence = 1 + alpha * purchase_count`` per encoded pair."""
    need = {"user_idx", "product_idx", "purchase_count"}
    missing = need - set(encoded.columns)
    if missing:
        raise ValueError(f"encoded frame lacks columns {sorted(missing)}")
    return encoded.select("user_idx", "product_idx",
                          confidence(F.col("purchase_count"), alpha).alias("confidence"))


def interaction_matrix(weights: DataFrame) -> DataFrame:
    """Sparse user×item matrix in COO form; duplicate cells are summed."""
    return (weights.groupBy("user_idx", "product_idx")
                   .agg(F.sum("confidence").alias("confidence")))


def transpose(matrix: DataFrame) -> DataFrame:
    """item×user view of the same cells."""
    return matrix.select("product_idx", "user_idx", "confidence")


def matrix_stats(matrix: DataFrame) -> DataFrame:
    """Shape (max index + 1), nnz and sparsity in one aggregate."""
    stats = matrix.agg(
        (F.max("user_idx") + 1).cast("bigint").alias("n_rows"),
        (F.max("product_idx") + 1).cast("bigint").alias("n_cols"),
        F.count(F.lit(1)).cast("bigint").alias("nnz"))
    return stats.withColumn(
        "sparsity",
        F.round(F.lit(1.0) - F.col("nnz").cast("double")
                / (F.col("n_rows").cast("double") * F.col("n_cols").cast("double")), 6))


def ground_truth(test: DataFrame, encoder: Encoder) -> DataFrame:
    """Test pairs whose user and product are both in the train dictionaries."""
    return (test.select("user_id", "product_id")
                .join(encoder.users.select("user_id"), "user_id", "left_semi")
                .join(encoder.products.select("product_id"), "product_id", "left_semi")
                .select("user_id", "product_id")
                .distinct())


def ground_truth_stats(truth: DataFrame) -> DataFrame:
    """Users, empty sets (none can occur in long form), mean / min / max set size."""
    sizes = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_users"),
        F.count_if(F.col("n") == 0).alias("n_empty"),
        F.round(F.avg("n"), 6).alias("mean_size"),
        F.min("n").cast("bigint").alias("min_size"),
        F.max("n").cast("bigint").alias("max_size"))


def user_histories(train: DataFrame) -> DataFrame:
    """Export form: user_id, sorted array of train products."""
    return train.groupBy("user_id").agg(
        F.sort_array(F.collect_set("product_id")).alias("items"))


def save_params(spark: SparkSession, path: str, params: dict) -> None:
    """A one-row JSON parameter file next to a saved model."""
    spark.createDataFrame([(json.dumps(params, sort_keys=True),)], "params string") \
         .coalesce(1).write.mode("overwrite").text(path)


def load_params(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])
