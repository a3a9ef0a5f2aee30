"""Dense dictionaries, unknown ids, matrix statistics."""

from pyspark.sql import functions as F

from basketry.operators.encode import (Encoder, confidence_weights, encode_train,
                                       interaction_matrix, matrix_stats, transpose)


def test_dense_sorted_and_unknown(spark):
    train = spark.createDataFrame([(30, 7, 2), (10, 9, 1), (20, 7, 1), (10, 7, 3)],
                                  "user_id bigint, product_id bigint, purchase_count bigint")
    enc = Encoder.fit(train)
    assert [(r[0], r[1]) for r in enc.users.orderBy("user_id").collect()] == [(10, 0), (20, 1), (30, 2)]
    assert [(r[0], r[1]) for r in enc.products.orderBy("product_id").collect()] == [(7, 0), (9, 1)]
    assert enc.sizes().first().asDict() == {"n_users": 3, "n_products": 2}
    test = spark.createDataFrame([(10, 9), (99, 7), (20, 5)], "user_id bigint, product_id bigint")
    got = {(r["user_id"], r["product_id"]): (r["user_idx"], r["product_idx"])
           for r in enc.transform(test, strict=False).collect()}
    assert got == {(10, 9): (0, 1), (99, 7): (-1, 0), (20, 5): (1, -1)}
    decoded = enc.decode_products(enc.transform(test, strict=True).select("user_idx", "product_idx"))
    assert [r["product_id"] for r in decoded.collect()] == [9]


def test_confidence_matrix_and_stats(spark):
    train = spark.createDataFrame([(1, 5, 2), (2, 5, 1), (2, 6, 1)],
                                  "user_id bigint, product_id bigint, purchase_count bigint")
    enc = Encoder.fit(train)
    m = interaction_matrix(confidence_weights(encode_train(train, enc), alpha=40.0))
    cells = {(r["user_idx"], r["product_idx"]): r["confidence"] for r in m.collect()}
    assert cells == {(0, 0): 81.0, (1, 0): 41.0, (1, 1): 41.0}
    assert transpose(m).columns == ["product_idx", "user_idx", "confidence"]
    st = matrix_stats(m).first()
    assert (st["n_rows"], st["n_cols"], st["nnz"]) == (2, 2, 3)
    assert st["sparsity"] == 0.25


def test_large_dictionary_is_dense(spark):
    ids = spark.range(0, 30000, 3).select((F.col("id") * 7 % 100003).alias("user_id"))
    users = Encoder.fit(ids.withColumn("product_id", F.lit(1))).users
    rows = users.orderBy("user_id").collect()
    assert [r["user_idx"] for r in rows] == list(range(len(rows)))
    assert [r["user_id"] for r in rows] == sorted(r["user_id"] for r in rows)
