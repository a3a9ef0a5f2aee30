"""Quality rules judged per host.

An Arrow pass measures every whole text; rules turn the measures into failures.
Failures are counted per host (the ``source`` column), each rule's rates get an
empirical beta prior (beta-binomial moments weighted by the hosts' sizes, so that the
chance spread of small hosts is not taken for a difference), and a host whose
shrunk rate exceeds ``host_limit`` is flagged for that rule; a rate equal to it is not. The verdicts are
joined back: a document goes when it fails a rule its own host is flagged for.
Documents that pass the rules stay, whatever their host.

Hosts are pre-aggregated before the shuffle, so a hot host is a few partial
rows; the join back is a plain equi-join whose large side AQE can split. Null
hosts are one host of their own. Null text has no words. Rows are never
matched by id, so repeated rows and null ids each keep their row. Long texts are measured
whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.texts import as_bytes, chunks
from basketry.session import checkpoint_root

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
HOST_LIMIT = 0.5
# A prior counts for so many documents at least: one observation never condemns a host.
LEAST_PRIOR = 10.0
_BLANK = bytes([0x20, *range(0x09, 0x0E)])
# Bytes that are not the first of a code point.
_INNER = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"


def measure(text: bytes, span: int = 5) -> tuple[int, ...]:
    """MEASURES of one UTF-8 text. Words: runs without ASCII white space."""
    w = text.split()
    grams = list(zip(*(w[i:] for i in range(span))))
    repeated = 0
    if len(set(grams)) < len(grams):
        seen, upto = Counter(grams), 0
        for i, g in enumerate(grams):
            if seen[g] > 1:
                repeated += i + span - max(i, upto)
                upto = i + span
    lines = [x for x in text.split(b"\n") if x.strip(_BLANK)]
    return (len(w), len(text.translate(None, _BLANK + _INNER)),
            len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated, len(lines))


def measures(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source",
             text_col: str = "text") -> DataFrame:
    """(id, host, MEASURES) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"),
                       F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in chunks(batches, "text"):
            cols = list(zip(*(measure(t) for t in as_bytes(b.column(2)))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(c, pa.int64()) for c in cols)],
                ["id", "host", *MEASURES])

    fields = ", ".join(f"{m} long" for m in MEASURES)
    return rows.mapInArrow(run, f"id {kind}, host string, {fields}")


def rules() -> dict[str, Column]:
    """Failure of each rule, never null."""
    n = F.col("n_words")
    return {
        "short": n < 10,
        "repeats": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 12 * n),
    }


def base_failed() -> Column:
    checks = rules()
    return checks["short"] | checks["repeats"]


def beta_prior(hosts: int, docs: int, squares: float, failures: float, spread: float) -> tuple[float, float]:
    """(a, b) of a beta-binomial by moments weighted with host sizes.

    ``squares`` sums the squared sizes, ``spread`` the squared failures over the size.
    The variance between raw rates that single documents bring about by chance is taken
    off; what is left is the correlation within hosts, 1 / (a + b + 1). Where nothing is
    left (hosts of one document, say) the prior is as strong as all documents together, and
    it never weighs less than ``LEAST_PRIOR`` documents.
    """
    if not docs:
        return 0.5, 0.5
    mean = failures / docs
    chance, room = mean * (1 - mean), docs - squares / docs - (hosts - 1)
    within = ((spread - mean * mean * docs) / chance - (hosts - 1)) / room if chance > 0 and room > 0 else 0.0
    total = (1 - within) / within if within > 0 else float(docs)
    total = max(min(total, float(docs)), LEAST_PRIOR)
    return max(mean * total, 1e-9), max((1 - mean) * total, 1e-9)


def host_verdicts(measured: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_docs, <rule>_rate, <rule>_bad) per host: shrunk rates and verdicts."""
    names = list(rules())
    per_host = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(c.cast("long")).alias(f"{r}_n") for r, c in rules().items()])
    n = F.col("n_docs")
    moments = per_host.agg(  # one row, whatever the number of hosts
        F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("docs"),
        F.sum(n.cast("double") * n).alias("squares"),
        *[F.sum(f"{r}_n").alias(f"{r}_m") for r in names],
        *[F.sum(F.col(f"{r}_n").cast("double") * F.col(f"{r}_n") / n).alias(f"{r}_v") for r in names]
    ).first()
    out = ["host", "n_docs"]
    for r in names:
        a, b = beta_prior(moments["hosts"], moments["docs"] or 0, moments["squares"] or 0.0,
                          moments[f"{r}_m"] or 0.0, moments[f"{r}_v"] or 0.0)
        rate = (F.col(f"{r}_n") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))
        out += [rate.alias(f"{r}_rate"), (rate > F.lit(host_limit)).alias(f"{r}_bad")]
    return per_host.select(*out)


def judge(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source",
          text_col: str = "text", host_limit: float = HOST_LIMIT) -> DataFrame:
    """(id, host, MEASURES, base_failed, host_flags, kept) of every row.

    The measures are written once to the checkpoint folder: hosts and rows
    both read them, and a lost executor never re-reads the texts.
    """
    checkpoint_root(docs.sparkSession)
    measured = measures(docs, id_col, host_col, text_col).checkpoint(eager=True)
    hosts = host_verdicts(measured, host_limit)
    flags = F.filter(F.array(*[F.when(F.col(f"{r}_bad"), F.lit(r)) for r in rules()]),
                     lambda x: x.isNotNull())
    verdicts = hosts.select(F.col("host").alias("h"), flags.alias("host_flags"))
    failed = F.filter(F.array(*[F.when(c, F.lit(r)) for r, c in rules().items()]),
                      lambda x: x.isNotNull())
    joined = measured.join(verdicts, measured["host"].eqNullSafe(verdicts["h"]), "left").drop("h")
    return (joined.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed")
                        & ~F.arrays_overlap(F.coalesce("host_flags", F.array().cast("array<string>")),
                                            failed))
            .withColumnRenamed("id", id_col))
