"""DuckDB SQL fragments that restate each registered query independently.

They run on the pre-registered test tables. Random choices use the same md5
order as the Spark plans; integers are BIGINT and published doubles are rounded
to six places on both sides. Frequent itemsets are counted by brute-force
self-joins (sizes 1..3), not by the FP-Growth the Spark side uses.
"""

from __future__ import annotations

from basketry.plans.fixtures import line_pairs_sql, order_lines_sql


def split_ctes(item: str = "part") -> str:
    return line_pairs_sql(item) + """,
freq AS (
  SELECT user_id, product_id, CAST(count(*) AS BIGINT) AS purchase_count
  FROM lines GROUP BY user_id, product_id
),
act AS (
  SELECT *, CAST(count(*) OVER (PARTITION BY user_id) AS BIGINT) AS n_items FROM freq
),
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY user_id
      ORDER BY md5('42:' || CAST(user_id AS VARCHAR) || ':' || CAST(product_id AS VARCHAR)),
               product_id) AS pos
  FROM act WHERE n_items >= 10
),
folds AS (
  SELECT user_id, product_id, purchase_count,
         CASE WHEN pos > n_items - greatest(1, CAST(floor(n_items * CAST(0.2 AS DOUBLE)) AS BIGINT))
              THEN 'test' ELSE 'train' END AS fold
  FROM ranked
),
train AS (SELECT user_id, product_id, purchase_count FROM folds WHERE fold = 'train'),
test AS (SELECT user_id, product_id FROM folds WHERE fold = 'test'),
users AS (
  SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_idx
  FROM (SELECT DISTINCT user_id FROM train)
),
products AS (
  SELECT product_id, CAST(row_number() OVER (ORDER BY product_id) - 1 AS INTEGER) AS product_idx
  FROM (SELECT DISTINCT product_id FROM train)
),
truth AS (
  SELECT DISTINCT user_id, product_id FROM test
  WHERE user_id IN (SELECT user_id FROM users) AND product_id IN (SELECT product_id FROM products)
)"""


def rule_ctes(min_support: float = 0.30, min_confidence: float = 0.45,
              min_lift: float = 1.0) -> str:
    """Itemsets (sizes 1..3) and rules on the brands train fold."""
    s = f"CAST({min_support!r} AS DOUBLE)"
    return split_ctes("brand") + f""",
nb AS (SELECT CAST(count(DISTINCT user_id) AS DOUBLE) AS n FROM train),
c1 AS (
  SELECT product_id AS a, count(*) AS freq FROM train GROUP BY product_id
  HAVING CAST(count(*) AS DOUBLE) / (SELECT n FROM nb) >= {s}
),
tf AS (SELECT user_id, product_id FROM train WHERE product_id IN (SELECT a FROM c1)),
c2 AS (
  SELECT x.product_id AS a, y.product_id AS b, count(*) AS freq
  FROM tf x JOIN tf y ON x.user_id = y.user_id AND x.product_id < y.product_id
  GROUP BY x.product_id, y.product_id
  HAVING CAST(count(*) AS DOUBLE) / (SELECT n FROM nb) >= {s}
),
c3 AS (
  SELECT x.product_id AS a, y.product_id AS b, z.product_id AS c, count(*) AS freq
  FROM tf x JOIN tf y ON x.user_id = y.user_id AND x.product_id < y.product_id
            JOIN tf z ON y.user_id = z.user_id AND y.product_id < z.product_id
  GROUP BY x.product_id, y.product_id, z.product_id
  HAVING CAST(count(*) AS DOUBLE) / (SELECT n FROM nb) >= {s}
),
itemsets AS (
  SELECT items, CAST(freq AS BIGINT) AS freq, CAST(freq AS DOUBLE) / (SELECT n FROM nb) AS support
  FROM (SELECT [a] AS items, freq FROM c1
        UNION ALL SELECT [a, b], freq FROM c2
        UNION ALL SELECT [a, b, c], freq FROM c3)
),
splits AS (
  SELECT support, [items[1]] AS antecedent, [items[2]] AS consequent FROM itemsets WHERE len(items) = 2
  UNION ALL SELECT support, [items[2]], [items[1]] FROM itemsets WHERE len(items) = 2
  UNION ALL SELECT support, [items[1]], [items[2], items[3]] FROM itemsets WHERE len(items) = 3
  UNION ALL SELECT support, [items[2]], [items[1], items[3]] FROM itemsets WHERE len(items) = 3
  UNION ALL SELECT support, [items[3]], [items[1], items[2]] FROM itemsets WHERE len(items) = 3
  UNION ALL SELECT support, [items[1], items[2]], [items[3]] FROM itemsets WHERE len(items) = 3
  UNION ALL SELECT support, [items[1], items[3]], [items[2]] FROM itemsets WHERE len(items) = 3
  UNION ALL SELECT support, [items[2], items[3]], [items[1]] FROM itemsets WHERE len(items) = 3
),
rules AS (
  SELECT array_to_string(antecedent, ',') || '>' || array_to_string(consequent, ',') AS rule_id,
         antecedent, consequent, support, confidence, confidence / con_support AS lift
  FROM (SELECT sp.antecedent, sp.consequent, sp.support, sp.support / a.support AS confidence,
               c.support AS con_support
        FROM splits sp JOIN itemsets a ON a.items = sp.antecedent
                       JOIN itemsets c ON c.items = sp.consequent)
  WHERE confidence >= CAST({min_confidence!r} AS DOUBLE)
    AND confidence / con_support >= CAST({min_lift!r} AS DOUBLE)
),
ridx AS (
  SELECT unnest(antecedent) AS item, rule_id, CAST(len(antecedent) AS BIGINT) AS ant_size,
         confidence
  FROM rules
)"""


def scoring_ctes(history: str = "train", key: str = "user_id", n: int = 10,
                 weight: str = "ant_size", prefix: str = "") -> str:
    """Fired rules, candidate scores and top-n over a (key, product_id) history.

    ``prefix`` names a second set of CTEs beside the first.
    """
    return f""",
{prefix}hist AS (SELECT DISTINCT {key}, product_id FROM {history}),
{prefix}fired AS (
  SELECT h.{key}, r.rule_id, r.ant_size, r.confidence
  FROM {prefix}hist h JOIN ridx r ON h.product_id = r.item
  GROUP BY h.{key}, r.rule_id, r.ant_size, r.confidence
  HAVING count(*) = r.ant_size
),
{prefix}cand AS (
  SELECT f.{key}, c.product_id,
         CAST(f.confidence AS DECIMAL(18,12)) * CAST({weight if weight != 'once' else 1} AS INTEGER) AS w
  FROM {prefix}fired f JOIN (SELECT rule_id, unnest(consequent) AS product_id FROM rules) c
       ON f.rule_id = c.rule_id
  WHERE NOT EXISTS (SELECT 1 FROM {prefix}hist h WHERE h.{key} = f.{key} AND h.product_id = c.product_id)
),
{prefix}scores AS (SELECT {key}, product_id, sum(w) AS score FROM {prefix}cand GROUP BY {key}, product_id),
{prefix}recs AS (
  SELECT {key}, rank, product_id, round(CAST(score AS DOUBLE), 6) AS score
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {key} ORDER BY score DESC, product_id)
                       AS BIGINT) AS rank
        FROM {prefix}scores)
  WHERE rank <= {n}
)"""


def metric_ctes(ks=(5, 10, 20)) -> str:
    """Per-user metrics of ``recs`` against ``truth``."""
    ks_list = ", ".join(str(k) for k in sorted(set(ks)))
    return f""",
rel AS (SELECT DISTINCT user_id, product_id FROM truth),
sizes AS (SELECT user_id, CAST(count(*) AS BIGINT) AS n_rel FROM rel GROUP BY user_id),
kt AS (SELECT CAST(unnest([{ks_list}]) AS BIGINT) AS k),
base AS (SELECT s.user_id, s.n_rel, kt.k FROM sizes s, kt),
hits AS (SELECT r.user_id, r.rank FROM recs r JOIN rel t ON r.user_id = t.user_id
                                                 AND r.product_id = t.product_id),
agg AS (
  SELECT b.user_id, b.k, b.n_rel,
         sum(CASE WHEN h.rank <= b.k THEN 1.0 / log2(h.rank + 1.0) END) AS dcg,
         count(CASE WHEN h.rank <= b.k THEN 1 END) AS n_hit,
         min(CASE WHEN h.rank <= b.k THEN h.rank END) AS first_hit
  FROM base b LEFT JOIN hits h ON h.user_id = b.user_id
  GROUP BY b.user_id, b.k, b.n_rel
),
per_user AS (
  SELECT user_id, k,
         coalesce(dcg / list_sum(list_transform(range(1, least(n_rel, k) + 1),
                                                lambda i: 1.0 / log2(i + 1.0))), 0.0) AS ndcg,
         coalesce(1.0 / first_hit, 0.0) AS mrr,
         CAST(n_hit AS DOUBLE) / n_rel AS recall,
         CAST(n_hit AS DOUBLE) / k AS precision
  FROM agg
),
summary AS (
  SELECT k, round(avg(ndcg), 6) AS ndcg, round(avg(mrr), 6) AS mrr,
         round(avg(recall), 6) AS recall, round(avg(precision), 6) AS precision,
         CAST(count(*) AS BIGINT) AS n_users
  FROM per_user GROUP BY k
)"""


def with_(*ctes: str) -> str:
    return "WITH " + "".join(ctes)


__all__ = ["split_ctes", "rule_ctes", "scoring_ctes", "metric_ctes", "with_",
           "order_lines_sql", "line_pairs_sql"]
