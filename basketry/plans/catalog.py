"""Registered queries: one Spark plan per operator, each with its DuckDB oracle.

Every query reads the test tables of ``sf_dir`` (or data Spark derives from
them) in full. ``QUERIES[name](spark, sf_dir) -> DataFrame``;
``ORACLE[name]`` is the equivalent DuckDB SQL when the operator is expressible
in SQL (ALS keys are checked by rows only, plus pytest fixed-point checks).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.exprs import r6
from basketry.functions.joins import dealt
from basketry.operators import encode as enc
from basketry.operators import metrics as met
from basketry.operators import predict as prd
from basketry.operators import prepare as prep
from basketry.operators import report as rep
from basketry.operators import rules as rl
from basketry.operators.als import FactorRecommender
from basketry.plans import common as cm
from basketry.plans import oracle as sql
from basketry.plans.fixtures import LINES_PER_PART, line_pairs, order_lines, table
from basketry.schema import REQUIRED_COLUMNS
from basketry.session import scratch_dir
from basketry.sources import readers, sinks
from basketry.streaming.baskets import score_basket_folder, write_basket_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- sources --
ORDER_LINES_SQL = sql.with_(sql.order_lines_sql("part")) + \
    f" SELECT {', '.join(REQUIRED_COLUMNS)} FROM order_lines"


def _written(spark: SparkSession, lines: DataFrame, fmt: str, suffix: str) -> str:
    """The lines in ``fmt``, text compressed: a line is some 220 characters of JSON, most of them keys."""
    path = scratch_dir(spark, "orderlines") + suffix
    text = lines.write.mode("overwrite").option("compression", "gzip")
    if fmt == "json":
        sinks.write_json_document(lines, path, compression="gzip")
    elif fmt in ("csv", "tsv"):
        text.option("header", True).option("sep", "\t" if fmt == "tsv" else ",").csv(path)
    elif fmt == "jsonl":
        text.json(path)
    else:
        sinks.write_table(lines, path, fmt)
    return path


def _roundtrip(spark: SparkSession, sf_dir: str, fmt: str, suffix: str) -> DataFrame:
    path = _written(spark, order_lines(spark, sf_dir), fmt, suffix)
    return readers.load_order_lines(spark, path).select(*REQUIRED_COLUMNS)


@query("load_parquet", ORDER_LINES_SQL)
def q_load_parquet(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "parquet", ".parquet")


@query("load_csv", ORDER_LINES_SQL)
def q_load_csv(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "csv", ".csv")


@query("load_tsv", ORDER_LINES_SQL)
def q_load_tsv(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "tsv", ".tsv")


@query("load_json", ORDER_LINES_SQL)
def q_load_json(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "json", ".json")


@query("load_jsonl", ORDER_LINES_SQL)
def q_load_jsonl(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "jsonl", ".jsonl")


@query("coerce_schema", ORDER_LINES_SQL)
def q_coerce_schema(spark, sf_dir):
    as_text = order_lines(spark, sf_dir).select(
        *[F.col(c).cast("string").alias(c) for c in REQUIRED_COLUMNS])
    return readers.coerce_schema(as_text)


# Faults planted by order key, the same on both sides.
FAULTS = {"user_id": ("order_id % 97 = 0", None), "product_id": ("order_id % 89 = 0", "'abc'"),
          "order_dow": ("order_id % 83 = 0", "'3.5'"), "reordered": ("order_id % 79 = 0", None),
          "days_since_prior_order": ("order_id % 73 = 0", "'soon'")}


def _faulty(c: str) -> str:
    where, what = FAULTS.get(c, ("false", None))
    return f"CASE WHEN {where} THEN {what or 'NULL'} ELSE CAST({c} AS {{text}}) END"


@query("validation_report", sql.with_(sql.order_lines_sql("part")) + " UNION ALL ".join(
    f" SELECT '{c}' AS \"column\", CAST(count(*) FILTER ({FAULTS[c][0]} AND {FAULTS[c][1] is None}) AS BIGINT)"
    f" AS n_null, CAST(count(*) FILTER ({FAULTS[c][0]} AND {FAULTS[c][1] is not None}) AS BIGINT) AS n_bad"
    f" FROM order_lines" if c in FAULTS else
    f" SELECT '{c}' AS \"column\", CAST(0 AS BIGINT) AS n_null, CAST(0 AS BIGINT) AS n_bad"
    for c in REQUIRED_COLUMNS))
def q_validation_report(spark, sf_dir):
    lines = order_lines(spark, sf_dir)
    return readers.validation_report(lines.select(
        *[F.expr(_faulty(c).format(text="STRING")).alias(c) for c in REQUIRED_COLUMNS]))


@query("column_check", sql.with_(sql.order_lines_sql("part")) + f"""
SELECT unnest([{', '.join(f"'{c}'" for c in REQUIRED_COLUMNS)}]) AS "column",
       CAST(count(*) AS BIGINT) AS n_rows, true AS named FROM order_lines""")
def q_column_check(spark, sf_dir):
    """Each required column taken away in turn: the check names exactly that one."""
    lines = order_lines(spark, sf_dir).checkpoint(eager=True)
    named = []
    for c in REQUIRED_COLUMNS:
        try:
            readers.check_columns(lines.drop(c))
            named.append(False)
        except ValueError as exc:
            named.append(str(exc).endswith(f"['{c}']"))
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(ok).alias("named"))
                     for c, ok in zip(REQUIRED_COLUMNS, named)])
    return lines.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(rows), "n_rows")


@query("suffix_dispatch", sql.with_(sql.order_lines_sql("part")) + f"""
SELECT unnest([{', '.join(f"'{s}'" for s in readers.SUFFIX_FORMATS)}]) AS suffix,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(product_id) AS BIGINT) AS product_sum
FROM order_lines""")
def q_suffix_dispatch(spark, sf_dir):
    """Order lines written once per format, read back under every accepted suffix."""
    base = sinks.write_table(order_lines(spark, sf_dir), scratch_dir(spark, "orderlines"))
    lines = spark.read.parquet(base)
    parts = []
    for suffix, fmt in readers.SUFFIX_FORMATS.items():
        path = _written(spark, lines, fmt, suffix)
        parts.append(readers.load_order_lines(spark, path).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("product_id").alias("product_sum"))
            .select(F.lit(suffix).alias("suffix"), "n_rows", "product_sum"))
    return reduce(DataFrame.unionByName, parts)


@query("dataset_profile", sql.with_(sql.order_lines_sql("part")) + """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(count(DISTINCT product_id) AS BIGINT) AS n_products, CAST(11 AS BIGINT) AS n_columns
FROM order_lines""")
def q_dataset_profile(spark, sf_dir):
    return readers.dataset_profile(order_lines(spark, sf_dir))


# ------------------------------------------------------------ preparation --
SPLIT = sql.with_(sql.split_ctes("part"))


@query("distinct_pairs", SPLIT + " SELECT DISTINCT user_id, product_id FROM lines")
def q_distinct_pairs(spark, sf_dir):
    return prep.distinct_pairs(line_pairs(spark, sf_dir))


@query("purchase_frequency", SPLIT + " SELECT * FROM freq")
def q_purchase_frequency(spark, sf_dir):
    return prep.purchase_frequency(line_pairs(spark, sf_dir))


@query("active_users", SPLIT + " SELECT user_id, product_id, purchase_count, n_items FROM act "
                               "WHERE n_items >= 10")
def q_active_users(spark, sf_dir):
    return prep.active_pairs(prep.purchase_frequency(line_pairs(spark, sf_dir)), 10)


@query("train_test_split", SPLIT + " SELECT * FROM folds")
def q_train_test_split(spark, sf_dir):
    return cm.split(spark, sf_dir).folds


@query("train_weighted", SPLIT + " SELECT * FROM train")
def q_train_weighted(spark, sf_dir):
    s = cm.split(spark, sf_dir)
    return prep.train_weighted(s.train.select("user_id", "product_id"), s.freq)


@query("fold_overlap", SPLIT + """
SELECT CAST(count(*) AS BIGINT) AS overlap_pairs
FROM train a JOIN test b ON a.user_id = b.user_id AND a.product_id = b.product_id""")
def q_fold_overlap(spark, sf_dir):
    s = cm.split(spark, sf_dir)
    return prep.fold_overlap(s.train, s.test)


@query("encode_users", SPLIT + " SELECT * FROM users")
def q_encode_users(spark, sf_dir):
    return cm.encoder(spark, sf_dir).users


@query("encode_products", SPLIT + " SELECT * FROM products")
def q_encode_products(spark, sf_dir):
    return cm.encoder(spark, sf_dir).products


@query("encode_unknown", SPLIT + """
SELECT t.user_id, t.product_id, coalesce(u.user_idx, -1) AS user_idx,
       coalesce(p.product_idx, -1) AS product_idx
FROM test t LEFT JOIN users u ON t.user_id = u.user_id
            LEFT JOIN products p ON t.product_id = p.product_id""")
def q_encode_unknown(spark, sf_dir):
    test = cm.split(spark, sf_dir).test
    return cm.encoder(spark, sf_dir).transform(test, strict=False).select(
        "user_id", "product_id", "user_idx", "product_idx")


@query("decode_products", SPLIT + """
SELECT u.user_idx, t.product_id
FROM train t JOIN users u ON t.user_id = u.user_id""")
def q_decode_products(spark, sf_dir):
    e = cm.encoder(spark, sf_dir)
    encoded = enc.encode_train(cm.split(spark, sf_dir).train, e).select("user_idx", "product_idx")
    return e.decode_products(encoded).select("user_idx", "product_id")


@query("encoder_sizes", SPLIT + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM users) AS n_users,
       (SELECT CAST(count(*) AS BIGINT) FROM products) AS n_products""")
def q_encoder_sizes(spark, sf_dir):
    return cm.encoder(spark, sf_dir).sizes()


ENCODED_SQL = """
SELECT u.user_idx, p.product_idx, 1.0 + 40.0 * CAST(t.purchase_count AS DOUBLE) AS confidence
FROM train t JOIN users u ON t.user_id = u.user_id JOIN products p ON t.product_id = p.product_id"""


def _weights(spark, sf_dir):
    e = cm.encoder(spark, sf_dir)
    return enc.confidence_weights(enc.encode_train(cm.split(spark, sf_dir).train, e), 40.0)


@query("confidence_weights", SPLIT + ENCODED_SQL)
def q_confidence_weights(spark, sf_dir):
    return _weights(spark, sf_dir)


@query("interaction_matrix", SPLIT + f"""
SELECT user_idx, product_idx, sum(confidence) AS confidence FROM ({ENCODED_SQL})
GROUP BY user_idx, product_idx""")
def q_interaction_matrix(spark, sf_dir):
    return enc.interaction_matrix(_weights(spark, sf_dir))


@query("matrix_stats", SPLIT + f"""
SELECT n_rows, n_cols, nnz,
       round(1.0 - CAST(nnz AS DOUBLE) / (CAST(n_rows AS DOUBLE) * CAST(n_cols AS DOUBLE)), 6)
         AS sparsity
FROM (SELECT CAST(max(user_idx) + 1 AS BIGINT) AS n_rows,
             CAST(max(product_idx) + 1 AS BIGINT) AS n_cols,
             CAST(count(*) AS BIGINT) AS nnz FROM ({ENCODED_SQL}))""")
def q_matrix_stats(spark, sf_dir):
    return enc.matrix_stats(enc.interaction_matrix(_weights(spark, sf_dir)))


@query("ground_truth", SPLIT + " SELECT * FROM truth")
def q_ground_truth(spark, sf_dir):
    return cm.truth(spark, sf_dir)


@query("ground_truth_stats", SPLIT + """
SELECT CAST(count(*) AS BIGINT) AS n_users, CAST(0 AS BIGINT) AS n_empty,
       round(avg(n), 6) AS mean_size, CAST(min(n) AS BIGINT) AS min_size,
       CAST(max(n) AS BIGINT) AS max_size
FROM (SELECT user_id, count(*) AS n FROM truth GROUP BY user_id)""")
def q_ground_truth_stats(spark, sf_dir):
    return enc.ground_truth_stats(cm.truth(spark, sf_dir))


@query("user_histories", SPLIT + """
SELECT user_id, list_sort(list(product_id)) AS items FROM train GROUP BY user_id""")
def q_user_histories(spark, sf_dir):
    return enc.user_histories(cm.split(spark, sf_dir).train)


@query("eval_sample", SPLIT + """
SELECT user_id FROM (SELECT DISTINCT user_id FROM truth)
ORDER BY md5('42:' || CAST(user_id AS VARCHAR)), user_id LIMIT 100""")
def q_eval_sample(spark, sf_dir):
    return prep.eval_sample(cm.truth(spark, sf_dir), 100, 42)


@query("split_sanity", SPLIT + """
SELECT 'overlap_pairs' AS metric, CAST(count(*) AS DOUBLE) AS value
FROM train a JOIN test b ON a.user_id = b.user_id AND a.product_id = b.product_id
UNION ALL SELECT 'train_users', CAST(count(DISTINCT user_id) AS DOUBLE) FROM train
UNION ALL SELECT 'test_users', CAST(count(DISTINCT user_id) AS DOUBLE) FROM test
UNION ALL SELECT 'truth_users', CAST(count(DISTINCT user_id) AS DOUBLE) FROM truth
UNION ALL SELECT 'truth_mean_size', round(avg(n), 6)
          FROM (SELECT user_id, count(*) AS n FROM truth GROUP BY user_id)""")
def q_split_sanity(spark, sf_dir):
    return prep.split_sanity(cm.split(spark, sf_dir).folds, cm.truth(spark, sf_dir))


# ------------------------------------------------------ association rules --
RULES = sql.with_(sql.rule_ctes())
BRAND_RECS = sql.with_(sql.rule_ctes(), sql.scoring_ctes("train", "user_id", cm.TOP_N))


@query("baskets", sql.with_(sql.split_ctes("brand")) + """
SELECT user_id, list_sort(list(product_id)) AS items FROM train GROUP BY user_id""")
def q_baskets(spark, sf_dir):
    return rl.baskets(cm.split(spark, sf_dir, "brand").train)


@query("baskets_without_empty", sql.with_(sql.split_ctes("brand")) + """
SELECT user_id, CAST(count(DISTINCT product_id) AS BIGINT) AS n_items FROM train
WHERE user_id % 3 <> 0 GROUP BY user_id""")
def q_baskets_without_empty(spark, sf_dir):
    """Users whose products are all unknown have no basket."""
    train = cm.split(spark, sf_dir, "brand").train.select(
        "user_id", F.when(F.col("user_id") % 3 != 0, F.col("product_id")).alias("product_id"))
    return rl.baskets(train).select("user_id", F.size("items").cast("bigint").alias("n_items"))


@query("rules_without_itemsets", RULES + """,
none AS (SELECT product_id FROM (SELECT product_id, count(*) AS c FROM train GROUP BY product_id), nb
         WHERE c / n >= 0.999)
SELECT CAST((SELECT n FROM nb) AS BIGINT) AS n_baskets, CAST(count(*) AS BIGINT) AS n_itemsets,
       CAST(0 AS BIGINT) AS n_rules, CAST(0 AS BIGINT) AS n_recs FROM none""")
def q_rules_without_itemsets(spark, sf_dir):
    """Support no itemset reaches: a model without rules that recommends nothing."""
    train = cm.split(spark, sf_dir, "brand").train
    m = rl.RuleModel.fit(train, rl.RuleParams(min_support=0.999, min_confidence=0.45))
    return m.recommend(train, cm.TOP_N).agg(F.count(F.lit(1)).alias("n_recs")).select(
        F.lit(m.n_baskets).cast("bigint").alias("n_baskets"),
        F.lit(m.n_itemsets).cast("bigint").alias("n_itemsets"),
        F.lit(m.n_rules).cast("bigint").alias("n_rules"), "n_recs")


@query("vocab_cap", SPLIT + """,
top AS (SELECT product_id FROM (SELECT product_id, count(DISTINCT user_id) AS n FROM train
                                GROUP BY product_id)
        ORDER BY n DESC, product_id LIMIT 50)
SELECT user_id, product_id FROM train WHERE product_id IN (SELECT product_id FROM top)""")
def q_vocab_cap(spark, sf_dir):
    train = cm.split(spark, sf_dir).train.select("user_id", "product_id")
    return rl.cap_vocabulary(train, 50)


@query("freq_itemsets", RULES + " SELECT items, freq, round(support, 6) AS support FROM itemsets")
def q_freq_itemsets(spark, sf_dir):
    m = cm.brand_rules(spark, sf_dir)
    return m.itemsets.select("items", "freq", r6("support").alias("support"))


@query("association_rules", RULES + """
SELECT rule_id, antecedent, consequent, round(support, 6) AS support,
       round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM rules""")
def q_association_rules(spark, sf_dir):
    m = cm.brand_rules(spark, sf_dir)
    return m.rules.select("rule_id", "antecedent", "consequent", r6("support").alias("support"),
                          r6("confidence").alias("confidence"), r6("lift").alias("lift"))


@query("rule_index", RULES + " SELECT item, rule_id, ant_size, round(confidence, 6) AS confidence "
                             "FROM ridx")
def q_rule_index(spark, sf_dir):
    return rl.rule_index(cm.brand_rules(spark, sf_dir).rules).withColumn(
        "confidence", r6("confidence"))


@query("fired_rules", BRAND_RECS + " SELECT user_id, rule_id, ant_size FROM fired")
def q_fired_rules(spark, sf_dir):
    m = cm.brand_rules(spark, sf_dir)
    return m.fired(cm.split(spark, sf_dir, "brand").train).select("user_id", "rule_id", "ant_size")


@query("rule_scores", BRAND_RECS + """
SELECT user_id, product_id, round(CAST(score AS DOUBLE), 6) AS score FROM scores""")
def q_rule_scores(spark, sf_dir):
    m = cm.brand_rules(spark, sf_dir)
    s = m.scores(cm.split(spark, sf_dir, "brand").train)
    return s.select("user_id", "product_id", r6("score").alias("score"))


@query("rule_recommend", BRAND_RECS + " SELECT * FROM recs")
def q_rule_recommend(spark, sf_dir):
    return cm.brand_recs(spark, sf_dir, cm.TOP_N)


# Ad-hoc baskets: each customer order is a basket of brands (the caller's
# basket replaces any stored history; the user is ignored).
ORDER_BASKETS_SQL = """,
order_baskets AS (
  SELECT DISTINCT o.o_orderkey AS basket_id, CAST(substr(p.p_brand, 7) AS BIGINT) AS product_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def order_baskets(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    n_lines = li.count()
    li = dealt(li, "l_orderkey", n_lines, LINES_PER_PART)
    orders = dealt(orders, "o_orderkey", n_lines, LINES_PER_PART)
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
              .join(part, li.l_partkey == part.p_partkey)
              .select(F.col("o_orderkey").alias("basket_id"),
                      F.substring("p_brand", 7, 16).cast("bigint").alias("product_id")))



@query("rule_recommend_basket", sql.with_(sql.rule_ctes(), ORDER_BASKETS_SQL,
                                          sql.scoring_ctes("order_baskets", "basket_id",
                                                           cm.TOP_N)) + " SELECT * FROM recs")
def q_rule_recommend_basket(spark, sf_dir):
    m = cm.brand_rules(spark, sf_dir)
    return m.recommend(order_baskets(spark, sf_dir), cm.TOP_N, key="basket_id")


@query("rules_roundtrip", BRAND_RECS + " SELECT * FROM recs")
def q_rules_roundtrip(spark, sf_dir):
    m = cm.brand_rules(spark, sf_dir)
    path = scratch_dir(spark, "rules-model")
    m.save(path)
    loaded = rl.RuleModel.load(spark, path)
    return loaded.recommend(cm.split(spark, sf_dir, "brand").train, cm.TOP_N)


# ------------------------------------------------------------ evaluation --
KMAX = max(cm.KS)
EVAL = sql.with_(sql.rule_ctes(), sql.scoring_ctes("train", "user_id", KMAX),
                 sql.metric_ctes(cm.KS))


def _eval_inputs(spark, sf_dir):
    return cm.brand_recs(spark, sf_dir, KMAX), cm.truth(spark, sf_dir, "brand")


def _per_user(spark, sf_dir):
    return cm.brand_per_user(spark, sf_dir)


def _rounded(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


PER_USER_COLS = ["ndcg", "mrr", "recall", "precision"]


@query("metric_ndcg", EVAL + " SELECT user_id, k, round(ndcg, 6) AS ndcg FROM per_user")
def q_metric_ndcg(spark, sf_dir):
    return _rounded(_per_user(spark, sf_dir).select("user_id", "k", "ndcg"), ["ndcg"])


@query("metric_mrr", EVAL + " SELECT user_id, k, round(mrr, 6) AS mrr FROM per_user")
def q_metric_mrr(spark, sf_dir):
    return _rounded(_per_user(spark, sf_dir).select("user_id", "k", "mrr"), ["mrr"])


@query("metric_recall", EVAL + " SELECT user_id, k, round(recall, 6) AS recall FROM per_user")
def q_metric_recall(spark, sf_dir):
    return _rounded(_per_user(spark, sf_dir).select("user_id", "k", "recall"), ["recall"])


@query("metric_precision", EVAL + " SELECT user_id, k, round(precision, 6) AS precision "
                                  "FROM per_user")
def q_metric_precision(spark, sf_dir):
    return _rounded(_per_user(spark, sf_dir).select("user_id", "k", "precision"), ["precision"])


@query("eval_per_user", EVAL + """
SELECT user_id, k, round(ndcg, 6) AS ndcg, round(mrr, 6) AS mrr, round(recall, 6) AS recall,
       round(precision, 6) AS precision FROM per_user""")
def q_eval_per_user(spark, sf_dir):
    return _rounded(_per_user(spark, sf_dir), PER_USER_COLS)


@query("eval_summary", EVAL + " SELECT * FROM summary")
def q_eval_summary(spark, sf_dir):
    return met.summary(_per_user(spark, sf_dir))


@query("eval_rules", EVAL + " SELECT * FROM summary")
def q_eval_rules(spark, sf_dir):
    recs, truth = _eval_inputs(spark, sf_dir)
    return met.evaluate(recs, truth, cm.KS)[0]


@query("per_user_ndcg", EVAL + " SELECT user_id, k, round(ndcg, 6) AS ndcg FROM per_user "
                               "WHERE k = 10")
def q_per_user_ndcg(spark, sf_dir):
    return _rounded(met.per_user_ndcg(_per_user(spark, sf_dir), cm.KS), ["ndcg"])


# ------------------------------------------------------------------- ALS --
# Factor values depend on MLlib's initialisation, so SQL cannot give them. What it
# can give is checked: list lengths and order, owned items, the fixed point of the
# normal equations and that a saved model recommends the same.
def _als(spark, sf_dir):
    return cm.als_model(spark, sf_dir)


@query("als_factors")
def q_als_factors(spark, sf_dir):
    return _als(spark, sf_dir).user_factors()


@query("als_recommend_one")
def q_als_recommend_one(spark, sf_dir):
    first = cm.truth(spark, sf_dir).agg(F.min("user_id").alias("user_id"))
    return _als(spark, sf_dir).recommend(first, cm.TOP_N)


@query("als_recommend")
def q_als_recommend(spark, sf_dir):
    s = cm.split(spark, sf_dir)
    cohort = prd.default_cohort(s.test, cm.encoder(spark, sf_dir))
    return _als(spark, sf_dir).recommend(cohort, cm.TOP_N)


@query("als_recommend_new")
def q_als_recommend_new(spark, sf_dir):
    s = cm.split(spark, sf_dir)
    cohort = prd.default_cohort(s.test, cm.encoder(spark, sf_dir))
    return _als(spark, sf_dir).recommend(cohort, cm.TOP_N, exclude_owned=True)


@query("als_roundtrip")
def q_als_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "als-model")
    _als(spark, sf_dir).save(path)
    loaded = FactorRecommender.load(spark, path)
    s = cm.split(spark, sf_dir)
    return loaded.recommend(prd.default_cohort(s.test, cm.encoder(spark, sf_dir)), cm.TOP_N)


COHORT_PART_SQL = SPLIT + """,
cohort AS (SELECT DISTINCT user_id FROM test WHERE user_id IN (SELECT user_id FROM users)),
n_all AS (SELECT count(*) AS n FROM products)"""


def _list_checks(spark, sf_dir, recs: DataFrame) -> DataFrame:
    """Per user: list length, and whether ranks, scores and products are as they must be."""
    products = cm.encoder(spark, sf_dir).products.select("product_id", F.lit(1).alias("known"))
    rows = recs.join(products, "product_id", "left")
    lists = rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_recs"),
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("items"),
        F.countDistinct("product_id").alias("n_products"), F.count("known").alias("n_known"))
    return lists.select(
        "user_id", "n_recs",
        (F.transform("items", lambda x: x["rank"])
         == F.sequence(F.lit(1).cast("bigint"), F.col("n_recs"))).alias("ranks_dense"),
        F.expr("forall(sequence(1, size(items) - 1), "
               "i -> i < 1 or i >= size(items) or items[i].score <= items[i - 1].score)").alias("scores_fall"),
        ((F.col("n_known") == F.col("n_recs")) & (F.col("n_products") == F.col("n_recs")))
        .alias("products_known"))


@query("als_recommend_checks", COHORT_PART_SQL + f"""
SELECT user_id, CAST(least({cm.TOP_N}, n) AS BIGINT) AS n_recs, true AS ranks_dense,
       true AS scores_fall, true AS products_known FROM cohort, n_all""")
def q_als_recommend_checks(spark, sf_dir):
    return _list_checks(spark, sf_dir, q_als_recommend(spark, sf_dir))


@query("als_recommend_new_checks", COHORT_PART_SQL + f"""
SELECT c.user_id, CAST(least({cm.TOP_N}, n - own) AS BIGINT) AS n_recs, true AS ranks_dense,
       true AS scores_fall, true AS products_known, CAST(0 AS BIGINT) AS n_owned
FROM cohort c, n_all, (SELECT user_id, count(*) AS own FROM train GROUP BY user_id) t
WHERE t.user_id = c.user_id""")
def q_als_recommend_new_checks(spark, sf_dir):
    recs = q_als_recommend_new(spark, sf_dir).checkpoint(eager=True)
    owned = recs.join(cm.split(spark, sf_dir).train.select("user_id", "product_id"),
                      ["user_id", "product_id"], "left_semi")
    owned = owned.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_owned"))
    return (_list_checks(spark, sf_dir, recs).join(owned, "user_id", "left")
            .withColumn("n_owned", F.coalesce("n_owned", F.lit(0).cast("bigint"))))


@query("als_fixed_point", SPLIT + " SELECT user_id, true AS solved FROM users")
def q_als_fixed_point(spark, sf_dir):
    return _als(spark, sf_dir).user_residuals().select(
        "user_id", (F.col("residual") < 1e-2).alias("solved"))


@query("als_item_factors", SPLIT + " SELECT product_id, 128 AS n_factors FROM products")
def q_als_item_factors(spark, sf_dir):
    return _als(spark, sf_dir).item_factors().select("product_id", F.size("features").alias("n_factors"))


@query("als_one_in_batch", COHORT_PART_SQL + f"""
SELECT min(user_id) AS user_id, CAST(least({cm.TOP_N}, min(n)) AS BIGINT) AS n_same
FROM cohort, n_all""")
def q_als_one_in_batch(spark, sf_dir):
    """The single-user list against the same user's rows of the batch."""
    one, batch = q_als_recommend_one(spark, sf_dir), q_als_recommend(spark, sf_dir)
    same = one.join(batch, ["user_id", "rank", "product_id"], "left_semi")
    return same.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_same"))


@query("als_roundtrip_diff", COHORT_PART_SQL + f"""
SELECT CAST(sum(least({cm.TOP_N}, n)) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_missing,
       CAST(0 AS BIGINT) AS n_extra FROM cohort, n_all""")
def q_als_roundtrip_diff(spark, sf_dir):
    a = q_als_recommend(spark, sf_dir).select("user_id", "rank", "product_id")
    b = q_als_roundtrip(spark, sf_dir).select("user_id", "rank", "product_id")
    tagged = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(-1)))
    diff = tagged.groupBy("user_id", "rank", "product_id").agg(
        F.sum("side").alias("diff"), F.count_if(F.col("side") == 1).alias("n"))
    return diff.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("diff") > 0).alias("n_missing"),
                    F.count_if(F.col("diff") < 0).alias("n_extra"))


@query("eval_als")
def q_eval_als(spark, sf_dir):
    truth = cm.truth(spark, sf_dir)
    recs = _als(spark, sf_dir).recommend(truth.select("user_id").distinct(), KMAX)
    return met.evaluate(recs, truth, cm.KS)[0]


# ------------------------------------------------------------- inference --

COHORT_SQL = """,
cohort AS (SELECT DISTINCT user_id FROM test WHERE user_id IN (SELECT user_id FROM users)),
preds AS (SELECT * FROM recs WHERE user_id IN (SELECT user_id FROM cohort))"""
INFER = sql.with_(sql.rule_ctes(), sql.scoring_ctes("train", "user_id", cm.TOP_N), COHORT_SQL)
INFER_EVAL = sql.with_(sql.rule_ctes(), sql.scoring_ctes("train", "user_id", KMAX),
                       sql.metric_ctes(cm.KS))


@query("cohort_default", INFER + " SELECT user_id FROM cohort")
def q_cohort_default(spark, sf_dir):
    return cm.brand_cohort(spark, sf_dir)


@query("predictions", INFER + " SELECT * FROM preds")
def q_predictions(spark, sf_dir):
    return cm.brand_predictions(spark, sf_dir)


@query("eval_restricted", INFER + """
SELECT user_id, product_id FROM truth WHERE user_id IN (SELECT user_id FROM cohort)""")
def q_eval_restricted(spark, sf_dir):
    return met.restrict_truth(cm.truth(spark, sf_dir, "brand"), cm.brand_cohort(spark, sf_dir))


@query("predictions_nested", INFER + " SELECT user_id, rank, product_id, score FROM preds")
def q_predictions_nested(spark, sf_dir):
    """The nested response, its items in list order, unfolded again for the comparison."""
    nested = prd.nested(cm.brand_predictions(spark, sf_dir))
    items = nested.select("user_id", F.posexplode("items").alias("pos", "item"))
    return items.select("user_id", (F.col("pos") + 1).cast("bigint").alias("rank"),
                        "item.product_id", "item.score")


@query("split_roundtrip", SPLIT + """
SELECT user_id, product_id, CASE WHEN fold = 'train' THEN purchase_count END AS purchase_count,
       fold FROM folds""")
def q_split_roundtrip(spark, sf_dir):
    s = cm.split(spark, sf_dir)
    path = scratch_dir(spark, "split")
    sinks.write_folds(s.folds, path)
    train, test = sinks.read_split(spark, path)
    return (train.withColumn("fold", F.lit("train"))
                 .unionByName(test.withColumns({"purchase_count": F.lit(None).cast("bigint"),
                                                "fold": F.lit("test")})))


@query("predictions_roundtrip", INFER + " SELECT *, 'fpgrowth' AS algorithm FROM preds")
def q_predictions_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "predictions")
    sinks.write_predictions(cm.brand_predictions(spark, sf_dir), path, "fpgrowth")
    return sinks.read_predictions(spark, path, "fpgrowth")


ONCE_RECS = sql.scoring_ctes("train", "user_id", cm.TOP_N, weight="once", prefix="once_")


@query("predictions_two_algorithms", INFER + ONCE_RECS + """
SELECT user_id, rank, product_id, score, 'fpgrowth' AS algorithm FROM preds
UNION ALL SELECT user_id, rank, product_id, score, 'fpgrowth_once' FROM once_recs
WHERE user_id IN (SELECT user_id FROM cohort)""")
def q_predictions_two_algorithms(spark, sf_dir):
    """Two writers of one predictions table, the first one twice: neither loses the other's rows."""
    path = scratch_dir(spark, "predictions")
    preds = cm.brand_predictions(spark, sf_dir)
    sinks.write_predictions(preds, path, "fpgrowth")
    own = cm.split(spark, sf_dir, "brand").train.join(cm.brand_cohort(spark, sf_dir), "user_id", "left_semi")
    once = rl.top_n(rl.rule_scores(own, cm.brand_rules(spark, sf_dir).numbered(), weight="once"), cm.TOP_N)
    sinks.write_predictions(once, path, "fpgrowth_once")
    sinks.write_predictions(preds, path, "fpgrowth")
    return sinks.read_predictions(spark, path)


@query("algorithm_switch", INFER + f""",
n_all AS (SELECT count(DISTINCT product_id) AS n FROM train)
SELECT 'fpgrowth' AS algorithm, CAST(count(*) AS BIGINT) AS n_rows, CAST(max(rank) AS BIGINT) AS max_rank
FROM preds
UNION ALL SELECT 'als', CAST(sum(least({cm.TOP_N}, n)) AS BIGINT),
                 CAST(max(least({cm.TOP_N}, n)) AS BIGINT) FROM cohort, n_all""")
def q_algorithm_switch(spark, sf_dir):
    """The same request answered by either recommender."""
    train, cohort = cm.split(spark, sf_dir, "brand").train, cm.brand_cohort(spark, sf_dir)
    models = dict(als=cm.small_als(spark, sf_dir), rules=cm.brand_rules(spark, sf_dir), history=train)
    parts = [prd.recommend(a, cohort, cm.TOP_N, **models).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("rank").alias("max_rank"))
        .select(F.lit(a).alias("algorithm"), "n_rows", "max_rank") for a in prd.ALGORITHMS]
    return parts[0].unionByName(parts[1])


@query("eval_union", INFER_EVAL + """
SELECT *, 'fpgrowth' AS algorithm, 'train' AS stage FROM summary
UNION ALL SELECT *, 'fpgrowth' AS algorithm, 'infer' AS stage FROM summary""")
def q_eval_union(spark, sf_dir):
    recs, truth = _eval_inputs(spark, sf_dir)
    train_summary = met.evaluate(recs, truth, cm.KS)[0]
    cohort = cm.brand_cohort(spark, sf_dir)
    infer_summary = met.evaluate(recs, truth, cm.KS, users=cohort)[0]
    path = scratch_dir(spark, "summary")
    sinks.write_table(sinks.label_summary(infer_summary, "fpgrowth", "infer"), path)
    stored = spark.read.parquet(path)
    return sinks.union_summaries({
        "fpgrowth_train": sinks.label_summary(train_summary, "fpgrowth", "train"),
        "fpgrowth_infer": stored,
        "als_train": None,          # not produced in this run: skipped
    })


# --------------------------------------------------------------- reports --
PRED_STATS = """,
vals AS (SELECT CAST(score AS DOUBLE) AS x FROM preds WHERE score IS NOT NULL)"""


def _hist_sql(bins: int, extra: str = "") -> str:
    return f""",
st0 AS (SELECT min(x) AS lo0, max(x) AS hi0, count(*) AS n FROM vals),
st AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
              CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi, n FROM st0),
stw AS (SELECT lo, hi, n, (hi - lo) / {float(bins)!r} AS w FROM st),
cnt AS (
  SELECT least(greatest(CAST(floor((x - lo) / w) AS BIGINT), 0), {bins - 1}) AS bin,
         CAST(count(*) AS BIGINT) AS c
  FROM vals, stw GROUP BY 1
)
SELECT g.bin, round(lo + g.bin * w, 6) AS bin_lo, round(lo + (g.bin + 1) * w, 6) AS bin_hi,
       coalesce(c, 0) AS count, round(CAST(coalesce(c, 0) AS DOUBLE) / (n * w), 6) AS density{extra}
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range({bins})) g CROSS JOIN stw
LEFT JOIN cnt ON cnt.bin = g.bin WHERE n > 0"""


def _kde_sql(points: int, grid: tuple | None = None, min_n: int = 1) -> str:
    lo, hi = (f"CAST({grid[0]!r} AS DOUBLE)", f"CAST({grid[1]!r} AS DOUBLE)") if grid \
        else ("lo", "hi")
    return f""",
st AS (SELECT count(*) AS n, stddev_samp(x) * 0.3 AS h, min(x) AS lo, max(x) AS hi FROM vals),
grp AS (SELECT x AS v, count(*) AS w FROM vals GROUP BY x),
pts AS (SELECT CAST(range AS BIGINT) AS point FROM range({points})),
gridx AS (SELECT point, {lo} + point * (({hi} - {lo}) / {float(points - 1)!r}) AS x, n, h
          FROM pts CROSS JOIN st),
curve AS (
  SELECT point, x, n, h, sum(w * exp(-0.5 * ((x - v) / h) * ((x - v) / h))) AS mass
  FROM gridx CROSS JOIN grp GROUP BY point, x, n, h
)
SELECT point, round(x, 6) AS x, round(mass / (n * h * sqrt(2.0 * pi())), 6) AS density
FROM curve WHERE h > 0 AND n > 1 AND n > {min_n}"""


@query("rec_popularity", INFER + """
SELECT product_id, CAST(count(*) AS BIGINT) AS n_recommended FROM preds GROUP BY product_id
ORDER BY n_recommended DESC, product_id LIMIT 20""")
def q_rec_popularity(spark, sf_dir):
    return rep.rec_popularity(cm.brand_predictions(spark, sf_dir), 20)


@query("score_histogram", INFER + PRED_STATS + _hist_sql(40))
def q_score_histogram(spark, sf_dir):
    return rep.score_histogram(cm.brand_predictions(spark, sf_dir), 40)


@query("score_density", INFER + PRED_STATS + _kde_sql(300))
def q_score_density(spark, sf_dir):
    return rep.score_density(cm.brand_predictions(spark, sf_dir), 300, 0.3)


HITS_SQL = """,
hpu AS (
  SELECT u.user_id, CAST(count(t.product_id) AS BIGINT) AS hits
  FROM (SELECT DISTINCT user_id FROM preds WHERE user_id IN (SELECT user_id FROM truth)) u
  LEFT JOIN (SELECT p.user_id, p.product_id FROM preds p JOIN truth t2
               ON p.user_id = t2.user_id AND p.product_id = t2.product_id) t
    ON u.user_id = t.user_id
  GROUP BY u.user_id
)"""


@query("hits_per_user", INFER + HITS_SQL + " SELECT * FROM hpu")
def q_hits_per_user(spark, sf_dir):
    return rep.hits_per_user(cm.brand_predictions(spark, sf_dir), cm.truth(spark, sf_dir, "brand"))


@query("hits_histogram", INFER + HITS_SQL + """
SELECT hits, CAST(count(*) AS BIGINT) AS n_users,
       round((SELECT avg(hits) FROM hpu), 6) AS mean_hits
FROM hpu GROUP BY hits""")
def q_hits_histogram(spark, sf_dir):
    per_user = rep.hits_per_user(cm.brand_predictions(spark, sf_dir),
                                 cm.truth(spark, sf_dir, "brand"))
    return rep.hits_histogram(per_user)


@query("catalog_coverage", INFER + """
SELECT n_recommended, n_catalog, round(CAST(n_recommended AS DOUBLE) / n_catalog, 6) AS coverage
FROM (SELECT CAST(count(DISTINCT product_id) AS BIGINT) AS n_recommended,
             (SELECT CAST(count(*) AS BIGINT) FROM products) AS n_catalog FROM preds)""")
def q_catalog_coverage(spark, sf_dir):
    return rep.catalog_coverage(cm.brand_predictions(spark, sf_dir),
                                cm.encoder(spark, sf_dir, "brand").sizes())


RPU_SQL = """,
rpu AS (
  SELECT c.user_id, CAST(count(p.product_id) AS BIGINT) AS n_recs
  FROM cohort c LEFT JOIN preds p ON c.user_id = p.user_id GROUP BY c.user_id
)"""


@query("recs_per_user", INFER + RPU_SQL + " SELECT * FROM rpu")
def q_recs_per_user(spark, sf_dir):
    return rep.recs_per_user(cm.brand_predictions(spark, sf_dir), cm.brand_cohort(spark, sf_dir))


@query("recs_per_user_hist", INFER + RPU_SQL + """,
vals AS (SELECT CAST(n_recs AS DOUBLE) AS x FROM rpu)""" + _hist_sql(
    30, ", round((SELECT avg(n_recs) FROM rpu), 6) AS mean_recs"))
def q_recs_per_user_hist(spark, sf_dir):
    per_user = rep.recs_per_user(cm.brand_predictions(spark, sf_dir),
                                 cm.brand_cohort(spark, sf_dir))
    return rep.recs_per_user_histogram(per_user, 30)


# Report panels use the published per-user NDCG (six decimals), so values on
# a bin edge fall into the same bin in every engine.
NDCG_VALS = """,
vals AS (SELECT round(ndcg, 6) AS x FROM per_user WHERE k = 10)"""


def _ndcg10(spark, sf_dir):
    return _rounded(met.per_user_ndcg(_per_user(spark, sf_dir), cm.KS), ["ndcg"])


@query("ndcg_histogram", INFER_EVAL + NDCG_VALS + _hist_sql(40))
def q_ndcg_histogram(spark, sf_dir):
    return rep.ndcg_histogram(_ndcg10(spark, sf_dir), 40)


@query("ndcg_stats", INFER_EVAL + """
SELECT CAST(count(*) AS BIGINT) AS n_users, round(avg(x), 6) AS mean,
       round(median(x), 6) AS median FROM (SELECT round(ndcg, 6) AS x FROM per_user WHERE k = 10)""")
def q_ndcg_stats(spark, sf_dir):
    return rep.ndcg_stats(_ndcg10(spark, sf_dir))


@query("ndcg_density", INFER_EVAL + NDCG_VALS + _kde_sql(300, (0.0, 1.0), 10))
def q_ndcg_density(spark, sf_dir):
    return rep.ndcg_density(_ndcg10(spark, sf_dir), 300, 0.3, 10)


@query("metric_long", INFER_EVAL + """
SELECT k, 'ndcg' AS metric, ndcg AS value FROM summary
UNION ALL SELECT k, 'mrr', mrr FROM summary
UNION ALL SELECT k, 'recall', recall FROM summary
UNION ALL SELECT k, 'precision', precision FROM summary""")
def q_metric_long(spark, sf_dir):
    return rep.metric_long(met.summary(_per_user(spark, sf_dir)))


@query("metric_snapshot", INFER_EVAL + " SELECT * FROM summary WHERE k = 10")
def q_metric_snapshot(spark, sf_dir):
    return rep.metric_snapshot(met.summary(_per_user(spark, sf_dir)), 10)


@query("metric_table", INFER_EVAL + """
SELECT k, floor(ndcg * 10000.0 + 0.5) / 10000.0 AS ndcg, floor(mrr * 10000.0 + 0.5) / 10000.0 AS mrr,
       floor(recall * 10000.0 + 0.5) / 10000.0 AS recall,
       floor(precision * 10000.0 + 0.5) / 10000.0 AS precision, n_users FROM summary""")
def q_metric_table(spark, sf_dir):
    return rep.metric_table(met.summary(_per_user(spark, sf_dir)))


@query("user_report", INFER + """
SELECT p.user_id, p.rank, p.product_id, floor(p.score * 10000.0 + 0.5) / 10000.0 AS score,
       CAST(coalesce(nt.n, 0) AS BIGINT) AS n_train_items,
       CAST(coalesce(nr.n, 0) AS BIGINT) AS n_truth,
       CAST(CASE WHEN t.product_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS is_hit,
       CAST(sum(CASE WHEN t.product_id IS NULL THEN 0 ELSE 1 END)
            OVER (PARTITION BY p.user_id) AS BIGINT) AS hits
FROM preds p
LEFT JOIN truth t ON p.user_id = t.user_id AND p.product_id = t.product_id
LEFT JOIN (SELECT user_id, count(*) AS n FROM train GROUP BY user_id) nt ON nt.user_id = p.user_id
LEFT JOIN (SELECT user_id, count(*) AS n FROM truth GROUP BY user_id) nr ON nr.user_id = p.user_id
""")
def q_user_report(spark, sf_dir):
    s = cm.split(spark, sf_dir, "brand")
    return rep.user_report(cm.brand_predictions(spark, sf_dir), s.train,
                           cm.truth(spark, sf_dir, "brand"))


# ------------------------------------------------------------- streaming --
@query("stream_rule_recommend",
       sql.with_(sql.rule_ctes(), ORDER_BASKETS_SQL,
                 sql.scoring_ctes("order_baskets", "basket_id", cm.TOP_N)) + " SELECT * FROM recs")
def q_stream_rule_recommend(spark, sf_dir):
    """Order baskets streamed through the rule scorer (same result as the batch path).

    The source is dealt by product, so a basket's lines lie in several files
    and arrive over several epochs.
    """
    base = scratch_dir(spark, "basket-stream")
    lines = order_baskets(spark, sf_dir).repartition(3, "product_id")
    source = write_basket_files(lines, f"{base}/source")
    return score_basket_folder(spark, source, f"{base}/sink", f"{base}/checkpoint",
                               cm.brand_rules(spark, sf_dir), cm.TOP_N, files_per_trigger=2)
