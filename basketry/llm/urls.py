"""URL filters: rules first, then trust and distrust propagated over host links.

A rule names a host and a path prefix and fits the host with all its
subdomains; the longest fitting rule decides a url. Other urls are judged by
their host. Hosts of allowed urls are trusted seeds and hosts of blocked urls
distrusted seeds (each weighed by its share of such urls). Trust is
personalised PageRank along the host edges; distrust is the same along the
reversed edges, so hosts that link to bad ones inherit it. A host is blocked
when its distrust exceeds ``threshold`` times its trust; hosts without evidence
are allowed.

Host edges are counted from absolute and protocol-relative links; besides,
each host and its parent domain point at each other, so a site's hosts share
their standing even where pages hold site-relative links only. Edges are
aggregated to one row per host pair before anything else, each step is one
join and one aggregate on hosts with partial sums before the shuffle, and the
state is checkpointed every few steps. Mass that hosts without links would
lose is not redistributed: normalising the result has the same effect.

Null urls and urls without ``://`` have empty host and path, get no rule and
are judged as the host '' (allowed: it neither links nor is linked). Null html
has no links. Repeated rows and ids keep their rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import checkpoint_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>\\]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed values of the contract.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"),
         Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"),
         Rule("block", "com", "/de/"))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(host: Column, path: Column, rules=RULES, what: str = "text") -> Column:
    """The longest fitting rule's text or verdict; null where none fits."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & \
            F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.lit(getattr(r, what))).otherwise(out)
    return out


def judged_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, rule_verdict) of every row."""
    url = F.col(url_col)
    out = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    return out.select(id_col, "host", "path",
                      rule_column(F.col("host"), F.col("path"), rules).alias("rule"),
                      rule_column(F.col("host"), F.col("path"), rules, "verdict")
                      .alias("rule_verdict"))


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts, and parent domains both ways."""
    links = (pages.select(host_of(F.col(url_col)).alias("src"),
                          F.explode(F.regexp_extract_all(F.col(html_col), F.lit(LINK), 1)).alias("d"))
             .select("src", F.translate("d", UPPER, LOWER).alias("dst"))
             .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))
    known = links.select(F.explode(F.array("src", "dst")).alias("h")).unionByName(
        pages.select(host_of(F.col(url_col)).alias("h"))).distinct()
    parent = known.select("h", F.regexp_extract("h", r"^[^.]+\.([^.]+\..+)$", 1).alias("p")) \
        .filter("p != ''")
    family = parent.select(F.explode(F.array(
        F.struct(F.col("h").alias("src"), F.col("p").alias("dst")),
        F.struct(F.col("p").alias("src"), F.col("h").alias("dst")))).alias("e")).select("e.*")
    return (links.unionByName(family.withColumn("n", F.lit(1).cast("long")))
            .filter("src != dst and src != '' and dst != ''")
            .groupBy("src", "dst").agg(F.sum("n").alias("n")))


def seeds(judged: DataFrame) -> DataFrame:
    """(host, trust, distrust): each host's share of allowed and blocked urls."""
    per_host = judged.groupBy("host").agg(
        F.avg((F.coalesce("rule_verdict", F.lit("")) == "allow").cast("double")).alias("trust"),
        F.avg((F.coalesce("rule_verdict", F.lit("")) == "block").cast("double")).alias("distrust"))
    return per_host.filter("host != ''")


def propagate(edges: DataFrame, seed: DataFrame, damping: float = 0.85, steps: int = 12,
              checkpoint_every: int = 4) -> DataFrame:
    """(host, trust, distrust) after ``steps`` steps, each column summing to 1 (or all 0)."""
    checkpoint_root(edges.sparkSession)
    # Trust runs src -> dst shared among src's links, distrust dst -> src shared among dst's.
    out_sum = edges.groupBy("src").agg(F.sum("n").alias("out_n"))
    in_sum = edges.groupBy("dst").agg(F.sum("n").alias("in_n"))
    flows = (edges.join(out_sum, "src").select(
                 F.col("src").alias("from"), F.col("dst").alias("to"),
                 (F.col("n") / F.col("out_n") * damping).alias("trust_w"),
                 F.lit(0.0).alias("distrust_w"))
             .unionByName(edges.join(in_sum, "dst").select(
                 F.col("dst").alias("from"), F.col("src").alias("to"),
                 F.lit(0.0).alias("trust_w"),
                 (F.col("n") / F.col("in_n") * damping).alias("distrust_w")))
             .groupBy("from", "to").agg(F.sum("trust_w").alias("trust_w"),
                                        F.sum("distrust_w").alias("distrust_w"))
             .checkpoint(eager=True))
    seed = seed.checkpoint(eager=True)
    start = seed.select("host", (F.col("trust") * (1 - damping)).alias("trust"),
                        (F.col("distrust") * (1 - damping)).alias("distrust"))
    state = seed
    for step in range(1, steps + 1):
        moved = (state.join(flows, state["host"] == flows["from"])
                 .select(F.col("to").alias("host"), (F.col("trust") * F.col("trust_w")).alias("trust"),
                         (F.col("distrust") * F.col("distrust_w")).alias("distrust")))
        state = moved.unionByName(start).groupBy("host").agg(
            F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if step % checkpoint_every == 0 and step < steps:
            state = state.checkpoint(eager=True)
    state = state.checkpoint(eager=True)
    total = state.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    return state.select("host", (F.col("trust") / F.lit(total["t"] or 1.0)).alias("trust"),
                        (F.col("distrust") / F.lit(total["d"] or 1.0)).alias("distrust"))


def host_verdicts(ranks: DataFrame, threshold: float = 1.0) -> DataFrame:
    """(host, trust, distrust, host_verdict); ties stay allowed, by a margin relative to
    the values, which shrink as the host graph grows."""
    over = (F.col("distrust") > F.col("trust") * (threshold * (1 + 1e-9))) & (F.col("distrust") > 0)
    return ranks.select("host", "trust", "distrust",
                        F.when(over, "block").otherwise("allow").alias("host_verdict"))


def filter_urls(pages: DataFrame, rules=RULES, threshold: float = 1.0, id_col: str = "page_id",
                url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict) of every row."""
    judged = judged_urls(pages, rules, id_col, url_col)
    ranks = propagate(host_edges(pages, url_col, html_col), seeds(judged))
    hosts = host_verdicts(ranks, threshold).select("host", "host_verdict")
    return (judged.join(hosts, "host", "left")
            .select(id_col, "host", "path", "rule",
                    F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict")))
