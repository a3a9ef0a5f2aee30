"""Association rules: baskets, frequent itemsets, rules, rule-based top-N.

* Frequent itemsets come from MLlib ``PrefixSpan`` over one-element
  sequences (bounded at ``max_len`` while mining; it projects a basket once
  per frequent prefix it holds, gathers those of a prefix in a task only while they
  hold ``ITEMS_IN_A_TASK`` items at most, and keeps the frequent patterns of a round on
  the driver, a table the result is at least as large as) or MLlib
  ``FPGrowth`` (distributed FP-trees, no length bound). Both are
  re-filtered with the exact ``freq / n_baskets >= min_support`` test.
* Rules take *every* non-empty proper subset of an itemset as antecedent (so
  consequents may hold several items): a bit mask per split, expanded with
  SQL higher-order ``filter``; supports of both sides come from joins back to
  the itemset table on the sorted item arrays.
* Scoring is relational division: a rule fires for a basket when all of its
  antecedent items are in the basket, i.e. the basket ⋈ rule-index count per
  (basket, rule) equals the antecedent size. Rules carry an integer number
  inside; their tables are broadcast only after their row count is checked.
  Every shuffle is on (basket, product) or (basket, antecedent) after a partial
  aggregate, so one hot basket spreads over tasks; many lines are dealt by basket first,
  once repeated ones are gone, into partitions of ``LINES_PER_PART``, and all later
  aggregates stay in those. Scoring counts antecedents,
  not rules: one of a single item needs no count, and the weights of rules
  with the same antecedent are added up once per model.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass

from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions.joins import broadcast_if_small, dealt, union_on
from basketry.operators.bitmaps import bitmap_itemsets
from basketry.operators.encode import load_params, save_params
from basketry.schema import ITEMSET_SCHEMA, RULE_SCHEMA, require_columns
from basketry.session import checkpoint_root

# Exact decimal for score sums: addition order cannot change ties.
SCORE_DECIMAL = "decimal(18,12)"
# A line meets some hundred antecedents: a task's tables of fired ones grow with its lines.
LINES_PER_PART = 60_000
# PrefixSpan gathers a prefix's projected baskets in one task's memory up to so many items;
# patterns of larger ones are counted where the baskets are. (MLlib's default: 32 million, GBs of objects.)
ITEMS_IN_A_TASK = 200_000


# Support, confidence, lift and length of the default setting.
@dataclass(frozen=True)
class RuleParams:
    min_support: float = 0.01
    min_confidence: float = 0.2
    min_lift: float = 1.0
    max_len: int = 3
    max_items: int | None = None       # F4: keep only the most common products, on request
    weight: str = "antecedent_size"   # or "once"
    num_partitions: int | None = None  # miner partitions; None keeps the input's
    miner: str = "prefixspan"          # or "fpgrowth", "bitmap"


def baskets(train: DataFrame, key: str = "user_id") -> DataFrame:
    """(key, items) with items = sorted distinct products; empty baskets dropped."""
    require_columns(train, [key, "product_id"], "basket lines")
    out = train.groupBy(key).agg(F.sort_array(F.collect_set("product_id")).alias("items"))
    return out.filter(F.size("items") > 0)


def cap_vocabulary(pairs: DataFrame, max_items: int, key: str = "user_id") -> DataFrame:
    """Keep pairs of the ``max_items`` products found in the most baskets.

    Ties break by product id. The top list has at most ``max_items`` rows; it
    is broadcast when that bound is small.
    """
    counts = pairs.groupBy("product_id").agg(F.countDistinct(key).alias("n_baskets"))
    top = counts.orderBy(F.col("n_baskets").desc(), F.col("product_id")).limit(int(max_items))
    return pairs.join(broadcast_if_small(top.select("product_id"), int(max_items)),
                      "product_id", "left_semi")


def min_count(min_support: float, n_baskets: int) -> int:
    """Smallest integer count c with ``c / n >= min_support`` in double arithmetic."""
    c = max(int(math.floor(min_support * n_baskets)) - 1, 0)
    while c / n_baskets < min_support:
        c += 1
    return c


def frequent_itemsets(basket_df: DataFrame, n_baskets: int, min_support: float,
                      max_len: int, num_partitions: int | None = None,
                      miner: str = "prefixspan") -> DataFrame:
    """(items, freq, support) for itemsets of size <= ``max_len``.

    ``basket_df`` holds every basket counted in ``n_baskets`` (possibly with
    an emptied item list after a vocabulary cap).

    ``miner="prefixspan"`` (default) runs MLlib ``PrefixSpan`` with each basket
    as a one-element sequence: its frequent patterns are then exactly the
    frequent itemsets, and ``maxPatternLength`` stops the search at
    ``max_len`` instead of enumerating longer itemsets and dropping them.
    ``miner="fpgrowth"`` uses MLlib ``FPGrowth`` (no length bound while
    mining; longer itemsets are filtered afterwards). ``miner="bitmap"`` grows
    itemsets from bit rows of baskets by joins and aggregates alone. All are
    distributed and give the same rows; the exact ``freq / n >= min_support`` test is applied
    last whichever it is.
    """
    if n_baskets == 0:
        return basket_df.sparkSession.createDataFrame([], ITEMSET_SCHEMA)
    threshold = min_count(min_support, n_baskets)
    relaxed = max(threshold - 0.5, 0.0) / n_baskets
    if miner == "prefixspan":
        seqs = basket_df.select(F.array("items").alias("sequence"))
        if num_partitions:
            seqs = seqs.repartition(num_partitions)
        found = (PrefixSpan(minSupport=relaxed, maxPatternLength=max_len,
                            maxLocalProjDBSize=ITEMS_IN_A_TASK, sequenceCol="sequence")
                 .findFrequentSequentialPatterns(seqs)
                 .filter(F.size("sequence") == 1)
                 .select(F.col("sequence")[0].alias("items"), "freq"))
    elif miner == "fpgrowth":
        fp = FPGrowth(itemsCol="items", minSupport=relaxed, minConfidence=1.0)
        if num_partitions:
            fp = fp.setNumPartitions(num_partitions)
        found = fp.fit(basket_df).freqItemsets
    elif miner == "bitmap":
        found = bitmap_itemsets(basket_df, max(threshold, 1), max_len)
    else:
        raise ValueError(f"unknown miner {miner!r}")
    return (found.filter(F.size("items") <= max_len)
                 .filter(F.col("freq") >= threshold)
                 .select(F.sort_array(F.col("items").cast("array<bigint>")).alias("items"),
                         F.col("freq").cast("bigint").alias("freq"),
                         (F.col("freq").cast("double") / F.lit(float(n_baskets))).alias("support")))


def rule_key(ant: str = "antecedent", con: str = "consequent"):
    """Readable unique rule id, e.g. ``'3,7>12'`` (hash ids collide on splits)."""
    return F.concat(F.array_join(ant, ","), F.lit(">"), F.array_join(con, ","))


def association_rules(itemsets: DataFrame, min_confidence: float, min_lift: float,
                      n_itemsets: int | None = None) -> DataFrame:
    """All antecedent → consequent splits with confidence and lift filters."""
    splits = (itemsets.filter(F.size("items") >= 2)
              .select("items", F.col("support"),
                      F.explode(F.sequence(F.lit(1), F.expr("int(pow(2, size(items))) - 2")))
                       .alias("mask"))
              .select(F.col("support"),
                      F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 1)")
                       .alias("antecedent"),
                      F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 0)")
                       .alias("consequent")))
    sides = broadcast_if_small(itemsets.select("items", "support"), n_itemsets)
    ant = sides.select(F.col("items").alias("antecedent"), F.col("support").alias("ant_support"))
    con = sides.select(F.col("items").alias("consequent"), F.col("support").alias("con_support"))
    rules = (splits.join(ant, "antecedent").join(con, "consequent")
             .withColumn("confidence", F.col("support") / F.col("ant_support"))
             .withColumn("lift", F.col("confidence") / F.col("con_support"))
             .filter(F.col("confidence") >= F.lit(float(min_confidence)))
             .filter(F.col("lift") >= F.lit(float(min_lift))))
    return rules.select(rule_key().alias("rule_id"), "antecedent", "consequent",
                        "support", "confidence", "lift")


@dataclass
class ScoringWeights:
    """One row per antecedent, written once: (rule_no, antecedent, products of (scored, hi, lo)).

    ``hi`` and ``lo`` are a product's summed weight in whole millionths and in
    10^-12 of the rest, so that scores add up exactly in two long sums. The
    counts are the rows of the three tables that scoring joins.
    """

    table: DataFrame
    n_single: int   # (item, product) rows of antecedents of one item
    n_index: int    # item rows of longer antecedents
    n_many: int     # product rows of longer antecedents


@dataclass
class RuleModel:
    """Fitted itemsets and rules (checkpointed tables) plus their sizes."""

    itemsets: DataFrame
    rules: DataFrame
    n_baskets: int
    n_itemsets: int
    n_rules: int
    params: RuleParams
    _numbered: DataFrame | None = None
    _weights: ScoringWeights | None = None

    @classmethod
    def fit(cls, train: DataFrame, params: RuleParams = RuleParams(),
            key: str = "user_id") -> "RuleModel":
        spark = train.sparkSession
        checkpoint_root(spark)
        pairs = train.select(key, "product_id").distinct()
        full = baskets(pairs, key).checkpoint(eager=True)
        n_baskets = full.count()
        basket_df = full
        if params.max_items is not None:
            n_items = pairs.select("product_id").distinct().count()
            if n_items > params.max_items:
                kept = baskets(cap_vocabulary(pairs, params.max_items, key), key)
                # Baskets emptied by the cap still count in the support denominator.
                basket_df = full.select(key).join(kept, key, "left").select(
                    key, F.coalesce(F.col("items"), F.array().cast("array<bigint>")).alias("items"))
        # The miner keeps the baskets' partition count, which AQE sizes by
        # bytes, so it grows with the data. (Forcing 8 partitions on FP-Growth
        # replicated every dense basket into each item group: 2.6x slower at
        # sf0.1 than 1 partition.)
        itemsets = frequent_itemsets(basket_df, n_baskets, params.min_support,
                                     params.max_len, params.num_partitions, params.miner
                                     ).checkpoint(eager=True)
        n_itemsets = itemsets.count()
        rules = association_rules(itemsets, params.min_confidence, params.min_lift,
                                  n_itemsets).checkpoint(eager=True)
        return cls(itemsets, rules, n_baskets, n_itemsets, rules.count(), params)

    # -- inference -------------------------------------------------------
    def rule_index(self) -> DataFrame:
        return rule_index(self.rules)

    def numbered(self) -> DataFrame:
        """The rules with their integer numbers, numbered once per model."""
        if self._numbered is None:
            self._numbered = numbered(self.rules)
        return self._numbered

    def fired(self, history: DataFrame, key: str = "user_id") -> DataFrame:
        return fired_rules(history, self.numbered(), key)

    def scores(self, history: DataFrame, key: str = "user_id") -> DataFrame:
        if self._weights is None:
            self._weights = scoring_weights(self.rules, self.params.weight)
        return rule_scores(history, self.rules, key, self.params.weight, self._weights)

    def recommend(self, history: DataFrame, n: int = 10, key: str = "user_id") -> DataFrame:
        """Top-``n`` per basket of ``history`` lines (key, product_id)."""
        return top_n(self.scores(history, key), n, key)

    # -- persistence -----------------------------------------------------
    def save(self, path: str) -> None:
        self.itemsets.write.mode("overwrite").parquet(f"{path}/itemsets")
        self.rules.write.mode("overwrite").parquet(f"{path}/rules")
        save_params(self.rules.sparkSession, f"{path}/params",
                    {**asdict(self.params), "n_baskets": self.n_baskets,
                     "n_itemsets": self.n_itemsets, "n_rules": self.n_rules})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "RuleModel":
        meta = load_params(spark, f"{path}/params")
        counts = {k: meta.pop(k) for k in ("n_baskets", "n_itemsets", "n_rules")}
        return cls(spark.read.schema(ITEMSET_SCHEMA).parquet(f"{path}/itemsets"),
                   spark.read.schema(RULE_SCHEMA).parquet(f"{path}/rules"),
                   params=RuleParams(**meta), **counts)


def rule_index(rules: DataFrame) -> DataFrame:
    """Inverted index: (item, rule_id, ant_size, confidence) per antecedent item."""
    return rules.select(F.explode("antecedent").alias("item"), "rule_id",
                        F.size("antecedent").cast("bigint").alias("ant_size"), "confidence")


def numbered(rules: DataFrame) -> DataFrame:
    """``rules`` with a unique integer ``rule_no``, written once so that it never changes."""
    if "rule_no" in rules.columns:
        return rules
    checkpoint_root(rules.sparkSession)
    return rules.withColumn("rule_no", F.monotonically_increasing_id()).checkpoint(eager=True)


def _owned(history: DataFrame, key: str) -> DataFrame:
    """Distinct (key, product) pairs; repeated lines collapse in the tasks before the shuffle."""
    return dealt(history.select(key, "product_id").distinct(), key, history.count(), LINES_PER_PART)


def _fired(owned: DataFrame, rules: DataFrame, key: str, n_index: int | None = None,
           carried: tuple[str, ...] = ("confidence",)) -> DataFrame:
    """(key, rule_no, ant_size, *carried) of the rules whose antecedent a basket holds."""
    index = broadcast_if_small(rules.select(
        F.explode("antecedent").alias("item"), "rule_no", F.size("antecedent").alias("ant_size"),
        *carried), n_index)
    hits = owned.join(index, owned.product_id == index.item)
    # Size and confidence hang on the rule: they ride along instead of being group keys.
    return (hits.groupBy(key, "rule_no")
                .agg(F.count(F.lit(1)).alias("n_present"), F.max("ant_size").alias("ant_size"),
                     *[F.max(c).alias(c) for c in carried])
                .filter(F.col("n_present") == F.col("ant_size"))
                .drop("n_present"))


def fired_rules(history: DataFrame, rules: DataFrame, key: str = "user_id") -> DataFrame:
    """(key, rule_id, ant_size, confidence) for rules whose antecedent ⊆ basket."""
    rules = numbered(rules)
    names = broadcast_if_small(rules.select("rule_no", "rule_id"))
    return (_fired(_owned(history, key), rules, key).join(names, "rule_no")
            .select(key, "rule_id", F.col("ant_size").cast("bigint").alias("ant_size"), "confidence"))


def scoring_weights(rules: DataFrame, weight: str = "antecedent_size") -> ScoringWeights:
    """What every antecedent adds to every product, summed over its rules."""
    if weight not in ("antecedent_size", "once"):
        raise ValueError(f"unknown weight {weight!r}")
    checkpoint_root(rules.sparkSession)
    mult = F.size("antecedent") if weight == "antecedent_size" else F.lit(1)
    added = (rules.select("antecedent", F.explode("consequent").alias("scored"),
                          (F.col("confidence").cast(SCORE_DECIMAL) * mult).alias("w"))
             .groupBy("antecedent", "scored").agg(F.sum("w").alias("w"))
             .withColumn("hi", F.floor(F.col("w") * 1_000_000).cast("bigint")))
    rest = F.col("w") * 1_000_000 - F.col("hi")
    table = (added.withColumn("lo", (rest * 1_000_000).cast("bigint")).groupBy("antecedent")
             .agg(F.collect_list(F.struct("scored", "hi", "lo")).alias("products"))
             .withColumn("rule_no", F.monotonically_increasing_id()).checkpoint(eager=True))
    one = F.size("antecedent") == 1
    rows = lambda cond, col: F.coalesce(F.sum(F.when(cond, F.size(col))), F.lit(0))
    return ScoringWeights(table, *table.agg(rows(one, "products"), rows(~one, "antecedent"),
                                            rows(~one, "products")).first())


def rule_scores(history: DataFrame, rules: DataFrame, key: str = "user_id",
                weight: str = "antecedent_size",
                weights: ScoringWeights | None = None) -> DataFrame:
    """(key, product_id, score) — summed confidences of fired rules per
    consequent item not already in the basket.

    ``weight="antecedent_size"`` adds a rule once per antecedent item (its
    confidence × antecedent size); ``"once"`` adds it once. Sums are exact
    (DECIMAL(38,12)), so the order of addition cannot change ties.
    Owned items are removed by aggregating candidates together with the
    basket's own rows (``max(owned) = 0``) rather than by an anti-join.
    ``weights`` are those of ``rules`` where they are at hand already.
    """
    weights = weights or scoring_weights(rules, weight)
    owned = _owned(history, key)
    one = F.size("antecedent") == 1
    single = broadcast_if_small(weights.table.filter(one).select(
        F.col("antecedent")[0].alias("item"), F.inline("products")), weights.n_single)
    added = [owned.join(single, owned.product_id == single.item).select(key, "scored", "hi", "lo")]
    if weights.n_index:
        longer = weights.table.filter(~one)
        gains = broadcast_if_small(longer.select("rule_no", F.inline("products")), weights.n_many)
        fired = _fired(owned, longer.select("rule_no", "antecedent"), key, weights.n_index, ())
        added.append(fired.join(gains, "rule_no").select(key, "scored", "hi", "lo"))
    none = F.lit(None).cast("bigint")
    rows = [a.withColumn("is_owned", F.lit(0)) for a in added]
    rows.append(owned.select(key, F.col("product_id").alias("scored"), none.alias("hi"),
                             none.alias("lo"), F.lit(1).alias("is_owned")))
    scored = (union_on(rows, key).groupBy("_key", F.col("scored").alias("product_id"))
              .agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo"),
                   F.max("is_owned").alias("is_owned"))
              .filter(F.col("is_owned") == 0))
    score = F.expr("cast(cast(hi as decimal(19,0)) * 0.000001BD"
                   " + cast(lo as decimal(19,0)) * 0.000000000001BD as decimal(38,12))")
    return scored.select(F.col("_key").alias(key), "product_id", score.alias("score"))


def top_n(scores: DataFrame, n: int, key: str = "user_id") -> DataFrame:
    """First ``n`` per key by score desc, product id asc: (key, rank, product_id, score).

    ``row_number() <= n`` is planned as a partial + final WindowGroupLimit, so
    each map task already keeps only ``n`` rows per key.
    """
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("product_id"))
    ranked = scores.withColumn("rank", F.row_number().over(order).cast("bigint"))
    return (ranked.filter(F.col("rank") <= n)
                  .select(key, "rank", "product_id",
                          F.round(F.col("score").cast("double"), 6).alias("score")))
