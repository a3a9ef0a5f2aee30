"""Registered queries beyond the survey's base keys: time joins, rollups, bitmaps, streams.

Importing this module adds them to the catalog's ``QUERIES`` and ``ORACLE``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.functions.exprs import r6
from basketry.operators import bitmaps as bm
from basketry.operators import encode as enc
from basketry.operators import metrics as met
from basketry.operators import recommender as rec
from basketry.operators import report as rep
from basketry.operators import rules as rl
from basketry.operators import temporal as tm
from basketry.plans import common as cm
from basketry.plans import oracle as sql
from basketry.plans.catalog import (ENCODED_SQL, ORACLE, ORDER_LINES_SQL, QUERIES, SPLIT, _weights,
                                    _written, query)
from basketry.plans.fixtures import order_lines, table
from basketry.schema import REQUIRED_COLUMNS
from basketry.session import scratch_dir
from basketry.sources import buckets as bk
from basketry.sources import readers
from basketry.streaming import sessions as ses

__all__ = ["QUERIES", "ORACLE"]

# ----------------------------------------------------------------- time joins --
PURCHASES_SQL = """
purchases AS (
  SELECT o.o_custkey AS user_id, CAST(substr(p.p_brand, 7) AS BIGINT) AS product_id,
         CAST(o.o_orderdate AS DATE) - DATE '1992-01-01' AS day, o.o_orderkey AS order_id,
         CAST(l.l_linenumber AS BIGINT) AS line
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def _purchases(spark, sf_dir, item="brand"):
    """(user_id, product_id, day, order_id, line) of every order line; days from 1992-01-01."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    product = F.substring("p_brand", 7, 16).cast("bigint") if item == "brand" else F.col("p_partkey")
    return (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .join(part, lines.l_partkey == part.p_partkey)
            .select(F.col("o_custkey").alias("user_id"), product.alias("product_id"),
                    F.datediff(F.to_date("o_orderdate"), F.lit("1992-01-01").cast("date"))
                    .cast("long").alias("day"), F.col("o_orderkey").alias("order_id"),
                    F.col("l_linenumber").cast("long").alias("line")))


@query("previous_purchase", sql.with_(PURCHASES_SQL, """,
known AS (SELECT user_id, product_id, day, max(order_id) AS order_id FROM purchases GROUP BY ALL)""") + """
SELECT p.user_id, p.product_id, CAST(p.day AS BIGINT) AS day, p.order_id, p.line,
       CAST(k.day AS BIGINT) AS prev_day, k.order_id AS prev_order_id
FROM purchases p ASOF LEFT JOIN known k
  ON p.user_id = k.user_id AND p.product_id = k.product_id AND p.day > k.day""")
def q_previous_purchase(spark, sf_dir):
    """Every order line with the user's previous purchase of the product."""
    lines = _purchases(spark, sf_dir)
    known = lines.select("user_id", "product_id", "day", F.col("day").alias("prev_day"),
                         F.col("order_id").alias("prev_order_id"))
    return tm.as_of_join(lines, known, ["user_id", "product_id"], "day", ["prev_day", "prev_order_id"])


@query("last_order_before_event", """
WITH known AS (SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) - DATE '1992-01-01' AS day,
                      max(o_orderkey) AS order_id FROM orders GROUP BY ALL),
seen AS (SELECT event_id, user_id, CAST(ts AS DATE) - DATE '1992-01-01' AS day FROM events)
SELECT e.event_id, e.user_id, CAST(e.day AS BIGINT) AS day, k.order_id
FROM seen e ASOF LEFT JOIN known k ON e.user_id = k.user_id AND e.day >= k.day""")
def q_last_order_before_event(spark, sf_dir):
    """Every event with the user's last order up to its day."""
    day = lambda c: F.datediff(F.to_date(c), F.lit("1992-01-01").cast("date")).cast("long")
    seen = table(spark, sf_dir, "events").select("event_id", "user_id", day("ts").alias("day"))
    known = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"), day("o_orderdate").alias("day"),
        F.col("o_orderkey").alias("order_id"))
    return tm.as_of_join(seen, known, ["user_id"], "day", ["order_id"], strict=False)


@query("purchases_within_days", """
WITH bought AS (
  SELECT DISTINCT l.l_partkey AS product_id, o.o_orderkey AS order_id,
         CAST(o.o_orderdate AS DATE) - DATE '1992-01-01' AS day
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT a.product_id, a.order_id, b.order_id AS later_order_id, CAST(b.day - a.day AS BIGINT) AS days
FROM bought a JOIN bought b ON a.product_id = b.product_id AND b.day BETWEEN a.day AND a.day + 14
WHERE a.order_id <> b.order_id""")
def q_purchases_within_days(spark, sf_dir, days: int = 14):
    """Pairs of orders that bought the same product, the second up to ``days`` after the first."""
    bought = _purchases(spark, sf_dir, "part").select("product_id", "order_id", "day").distinct()
    first = bought.select("product_id", F.col("order_id").alias("first_order_id"),
                          F.col("day").alias("start"), (F.col("day") + days).alias("end"))
    pairs = tm.interval_join(bought, first, ["product_id"], "day", "start", "end")
    return pairs.filter("order_id <> first_order_id").select(
        "product_id", F.col("first_order_id").alias("order_id"),
        F.col("order_id").alias("later_order_id"), (F.col("day") - F.col("start")).alias("days"))


# ---------------------------------------------------------------- itemsets, lists --
@query("freq_itemsets_bitmap", ORACLE["freq_itemsets"])
def q_freq_itemsets_bitmap(spark, sf_dir):
    """The frequent itemsets by the bitmap miner."""
    b = rl.baskets(cm.split(spark, sf_dir, "brand").train)
    found = rl.frequent_itemsets(b, b.count(), cm.BRAND_RULES.min_support, cm.BRAND_RULES.max_len,
                                 miner="bitmap")
    return found.select("items", "freq", r6("support").alias("support"))


@query("eval_udtf", ORACLE["eval_summary"])
def q_eval_udtf(spark, sf_dir):
    """The evaluation of a callable that ranks each user's scored products itself."""
    train = cm.split(spark, sf_dir, "brand").train
    scores = cm.brand_rules(spark, sf_dir).scores(train)
    recs = rec.recommend_by(scores, rec.best_scores, max(cm.KS))
    return met.summary(met.per_user_metrics(recs, cm.truth(spark, sf_dir, "brand"), cm.KS))


# ------------------------------------------------------------------ bucketed tables --
def _bucketed(spark, sf_dir):
    """Histories, truth and predictions as catalog tables of the same buckets."""
    def build():
        s = cm.split(spark, sf_dir, "brand")
        frames = {"histories": s.train, "truth": cm.truth(spark, sf_dir, "brand"),
                  "predictions": cm.brand_predictions(spark, sf_dir)}
        tables = {}
        for name, df in frames.items():
            path = scratch_dir(spark, f"bucketed_{name}")
            tables[name] = bk.write_bucketed(df, path.rsplit("/", 1)[-1].replace("-", "_"), path)
        return tables
    return cm._memo(spark, ("bucketed", sf_dir), build)


@query("bucketed_rule_recommend", ORACLE["rule_recommend"])
def q_bucketed_rule_recommend(spark, sf_dir):
    """Rule recommendations from the bucketed histories."""
    return cm.brand_rules(spark, sf_dir).recommend(_bucketed(spark, sf_dir)["histories"], cm.TOP_N)


@query("bucketed_user_report", ORACLE["user_report"])
def q_bucketed_user_report(spark, sf_dir):
    """The user report from bucketed predictions, histories and truth."""
    t = _bucketed(spark, sf_dir)
    return rep.user_report(t["predictions"], t["histories"], t["truth"])


# ----------------------------------------------------------------- aggregations --
@query("popularity_rollup", sql.with_(sql.order_lines_sql("part")) + """
SELECT department_id, aisle_id, product_id,
       CAST(grouping(department_id, aisle_id, product_id) AS BIGINT) AS level,
       CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(reordered) AS BIGINT) AS n_reordered
FROM order_lines GROUP BY ROLLUP (department_id, aisle_id, product_id) HAVING count(*) >= 20""")
def q_popularity_rollup(spark, sf_dir):
    return rep.popularity_rollup(order_lines(spark, sf_dir), 20)


@query("popularity_cube", sql.with_(sql.order_lines_sql("part")) + """
SELECT department_id, order_dow, CAST(grouping(department_id, order_dow) AS BIGINT) AS level,
       CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(reordered) AS BIGINT) AS n_reordered
FROM order_lines GROUP BY CUBE (department_id, order_dow)""")
def q_popularity_cube(spark, sf_dir):
    return rep.popularity_cube(order_lines(spark, sf_dir), ["department_id", "order_dow"])


@query("profile_merged", sql.with_(sql.order_lines_sql("part")) + """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_user_id,
       CAST(count(DISTINCT product_id) AS BIGINT) AS n_product_id,
       CAST(count(DISTINCT order_id) AS BIGINT) AS n_order_id FROM order_lines""")
def q_profile_merged(spark, sf_dir):
    """The profile of two loads, merged from their bitmap tables."""
    lines, cols = order_lines(spark, sf_dir), ["user_id", "product_id", "order_id"]
    paths = []
    for name, load in (("a", lines.filter("order_number <= 3")), ("b", lines.filter("order_number > 3"))):
        paths.append(scratch_dir(spark, f"profile-{name}"))
        bm.bitmap_profile(load, cols).write.parquet(paths[-1])
    return bm.profile_counts(bm.merge_profiles([spark.read.parquet(p) for p in paths]), cols)


@query("profile_approximate", sql.with_(sql.order_lines_sql("part")) + """
SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS users_close, true AS products_close
FROM order_lines""")
def q_profile_approximate(spark, sf_dir):
    """The approximate profile is within 15 % (three standard errors) of the exact one."""
    lines = order_lines(spark, sf_dir)
    near = readers.dataset_profile(lines, approximate=True).select(
        "n_rows", F.col("n_users").alias("u"), F.col("n_products").alias("p"))
    exact = readers.dataset_profile(lines).select("n_rows", "n_users", "n_products")
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.15 * F.col(b)
    return near.join(exact, "n_rows").select("n_rows", close("u", "n_users").alias("users_close"),
                                             close("p", "n_products").alias("products_close"))


# ---------------------------------------------------------------- matrix, sources --
def _products_first(matrix):
    """The first and the last user of every product and its cells, by the transposed rows."""
    return matrix.groupBy("product_idx").agg(
        F.count(F.lit(1)).alias("n_users"), F.min("user_idx").alias("first_user"),
        F.max("user_idx").alias("last_user"), F.sum("confidence").alias("confidence"))


@query("matrix_transpose", SPLIT + f"""
SELECT product_idx, CAST(count(*) AS BIGINT) AS n_users, min(user_idx) AS first_user,
       max(user_idx) AS last_user, sum(confidence) AS confidence FROM ({ENCODED_SQL})
GROUP BY product_idx""")
def q_matrix_transpose(spark, sf_dir):
    """Rows of the item x user matrix, each summed up."""
    return _products_first(enc.transpose(enc.interaction_matrix(_weights(spark, sf_dir))))


@query("load_csv_typed", ORDER_LINES_SQL)
def q_load_csv_typed(spark, sf_dir):
    """CSV without validation: types are inferred."""
    path = _written(spark, order_lines(spark, sf_dir), "csv", ".csv")
    typed = readers.load_order_lines(spark, path, validate=False)
    return typed.select(*[F.col(c).cast("bigint") if dict(typed.dtypes)[c] == "int" else F.col(c)
                          for c in REQUIRED_COLUMNS])


# --------------------------------------------------------------------- streaming --
GAP, DELAY = "12 hours", "1 day"
ARRIVALS_SQL = """
arrivals AS (
  SELECT event_id, ts, user_id, value,
         ntile(4) OVER (ORDER BY ts, event_id) + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS epoch
  FROM events),
marks AS (SELECT epoch, max(max(ts)) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                        - INTERVAL 1 DAY AS mark FROM arrivals GROUP BY epoch),
judged AS (SELECT a.*, coalesce(a.ts <= m.mark, false) AS late FROM arrivals a JOIN marks m USING (epoch))"""


def _arrivals(spark, sf_dir):
    """Events as files of four quarters of time; errors arrive one file after their quarter."""
    from basketry.functions.ranking import position_in_groups
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "event_type")
    placed = position_in_groups(events, [], ["ts", "event_id"], "place")
    n = placed.count()
    large, base = n % 4, n // 4   # as ntile deals: the first groups are one larger
    edge = large * (base + 1)
    place = F.col("place")
    quarter = F.when(place <= edge, F.ceil(place / (base + 1))).otherwise(
        large + F.ceil((place - edge) / F.lit(max(base, 1))))
    return placed.withColumn("epoch", quarter + (F.col("event_type") == "error").cast("int"))


def _session_tables(spark, sf_dir):
    def build():
        path = scratch_dir(spark, "event-stream")
        arrivals = _arrivals(spark, sf_dir).checkpoint(eager=True)
        for epoch in range(1, 6):   # one job a file, so that files arrive in order
            (arrivals.filter(F.col("epoch") == epoch).select("event_id", "ts", "user_id", "value")
             .repartition(1).write.mode("append").parquet(f"{path}/source"))
        return ses.sessionise_folder(spark, f"{path}/source", path, GAP, DELAY)
    return cm._memo(spark, ("sessions", sf_dir), build)


@query("stream_sessions", sql.with_(ARRIVALS_SQL, """,
steps AS (SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                          + INTERVAL 12 HOURS THEN 1 ELSE 0 END AS opens
          FROM judged WHERE NOT late AND user_id IS NOT NULL),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM steps)""") + """
SELECT user_id, min(ts) AS start, max(ts) AS last_ts, CAST(count(*) AS BIGINT) AS n_events,
       round(sum(value), 2) AS total FROM numbered GROUP BY user_id, no""")
def q_stream_sessions(spark, sf_dir):
    """Sessions closed by event time over five epochs, late events left out."""
    closed, _, _ = _session_tables(spark, sf_dir)
    return closed.withColumn("total", F.round("total", 2))


@query("stream_late_events", sql.with_(ARRIVALS_SQL) + """
SELECT event_id, ts, user_id, value FROM judged WHERE late""")
def q_stream_late_events(spark, sf_dir):
    """The side table of events older than the watermark when they arrived."""
    return _session_tables(spark, sf_dir)[1]
