"""N-gram Jaccard join: a blocked sparse product of the document by n-gram matrix.

A document's row holds its distinct four-word shingles, a text with fewer words the
whole sequence as one. Rows with equal sets are one row of the matrix. Columns are
ordered from rare to frequent (counters of 2^18 hash slots over all documents; any
fixed order is right, a good one is fast). Two sets of at least 0.85 share a
column among the rarest ``n - ceil(0.85 n) + 1`` of each, so the product starts
from those columns: a bucket is a column with all rows that hold it there, and
``linking`` deals it to blocks. Inside a block the product of the rows' hashed
columns bounds the overlap of each pair from above, and pairs below what their sizes
ask for are discarded. What remains is accumulated over columns: with c shared
columns up to the point where the first of both prefixes ends, the overlap is at
most c plus the rest of that row; pairs below the bound from their sizes go, long rows
are bounded once more by maps as wide as they are, and the product over all columns of
the others decides, in whole numbers. Shingles are 64-bit hashes.

Texts without words (null, empty, blanks) have no shingle and are linked with
nothing: each such row is a component of its own. Null ids take part; a component
is named by its smallest non-null id. Repeated rows are copies like any other. An
empty table gives no rows; extra columns are ignored. Similarity equal to the limit
links. Texts are processed whole, in byte-bounded parts of rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import linking
from basketry.llm.texts import WordHashes, as_bytes, chunks, mixed
from basketry.session import checkpoint_root

SHINGLE = 4
SIMILARITY = 0.85
SLOT_BITS = 18
PART_BYTES = 1 << 20
_M = np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(text: bytes, known: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; words are runs without blanks, A-Z lower-cased."""
    h = known.of(text.lower().split())
    if not len(h):
        return h
    span = min(SHINGLE, len(h))
    out = np.full(len(h) - span + 1, span, np.uint64)
    for i in range(span):
        out = (out ^ h[i:len(h) - span + 1 + i]) * _M
        out ^= out >> np.uint64(32)
    return np.unique(mixed(out))


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def slot_counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """How many (document, shingle) entries fall on each of the 2^18 slots."""
    def run(batches):
        known, total = WordHashes(), np.zeros(1 << SLOT_BITS, np.int64)
        for b in chunks(batches, "text", PART_BYTES):
            for t in as_bytes(b.column(0)):
                total += np.bincount(_slots(shingles(t, known)), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["slot", "n"])

    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "slot long, n long")
            .groupBy("slot").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(1 << SLOT_BITS, np.int64)
    out[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return out


def least_overlap(n: int, ratio: linking.Ratio) -> int:
    """Shingles that a set of n shares at least with any set it is linked to."""
    return -(-ratio.num * n // ratio.den)


def signed_rows(docs: DataFrame, counts, ratio: linking.Ratio, id_col: str, text_col: str):
    """(id, raw, set, size, bits, wide, prefix, last): one row per document, ``set`` null without words."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("raw", T.BinaryType()),
        T.StructField("set", T.BinaryType()), T.StructField("size", T.LongType()),
        T.StructField("bits", T.BinaryType()), T.StructField("wide", T.BinaryType()),
        T.StructField("prefix", T.ArrayType(T.LongType())),
        T.StructField("last_n", T.LongType()), T.StructField("last_h", T.LongType())])

    def run(batches):
        known, frequency = WordHashes(), counts.value
        for b in chunks(batches, "text", PART_BYTES):
            out = []
            for t in as_bytes(b.column(1)):
                h = shingles(t, known)
                raw, n = hashlib.md5(t).digest(), len(h)
                if not n:
                    out.append((raw, None, 0, None, None, None, None, None))
                    continue
                often, signed = frequency[_slots(h)], h.view(np.int64)
                order = np.lexsort((signed, often))[:n - least_overlap(n, ratio) + 1]
                out.append((raw, xxhash.xxh3_128_digest(h.tobytes()), n, linking.parity_map(h),
                            linking.wide_map(h), signed[order], int(often[order[-1]]),
                            int(signed[order[-1]])))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*out), kinds))], schema.names)

    kinds = [pa.field("raw", pa.binary()), pa.field("set", pa.binary()), pa.field("size", pa.int64()),
             pa.field("bits", pa.binary()), pa.field("wide", pa.binary()),
             pa.field("prefix", pa.list_(pa.int64())), pa.field("last_n", pa.int64()),
             pa.field("last_h", pa.int64())]
    return rows.mapInArrow(run, schema)


def _accumulated(nodes: DataFrame, ratio: linking.Ratio):
    """Overlap counts over the shared columns, and the bound they leave."""
    def side(who: str) -> DataFrame:
        return nodes.select(F.col("node").alias(who), F.struct(
            F.col("last_n"), F.col("last_h")).alias(f"{who}_last"), F.col("size").alias(f"{who}_size"),
            (F.col("size") - F.col("n_prefix")).alias(f"{who}_rest"))

    def bound(pairs: DataFrame) -> DataFrame:
        counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
        sized = counted.join(side("a"), "a").join(side("b"), "b")
        rest = F.when(F.col("a_last") <= F.col("b_last"), F.col("a_rest")).otherwise(F.col("b_rest"))
        return sized.filter((F.col("shared") + rest) * (ratio.num + ratio.den)
                            >= (F.col("a_size") + F.col("b_size")) * ratio.num).select("a", "b")

    return bound


def jaccard_components(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    spark, ratio = docs.sparkSession, linking.Ratio(similarity)
    checkpoint_root(spark)
    counts = spark.sparkContext.broadcast(slot_counts(docs, text_col))  # 2 MB whatever the input
    rows = (signed_rows(docs, counts, ratio, id_col, text_col)
            .withColumn("row", F.monotonically_increasing_id()).checkpoint(eager=True))
    # A set is named by the row of its least id.
    sets = (rows.filter("set is not null").groupBy("set")
            .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("rep"))
            .select("set", F.col("rep.row").alias("node"), F.col("rep.id").alias("rep_id"))
            .checkpoint(eager=True))
    reps = rows.join(sets.select(F.col("node").alias("row")), "row", "left_semi").select(
        F.col("row").alias("node"), "id", "raw", "size", "bits", "wide", "prefix", "last_n", "last_h"
    ).checkpoint(eager=True)
    columns = reps.select(F.explode("prefix").alias("bucket"), "node")
    members = linking.shared_buckets(columns).checkpoint(eager=True)
    nodes = (reps.withColumn("n_prefix", F.size("prefix")).drop("prefix")
             .join(members.select("node").distinct(), "node", "left_semi").checkpoint(eager=True))
    named_by = nodes.select("node", F.col("id").alias("rep_id"), F.col("raw").alias("rep_raw"))
    texts_of = lambda some: linking.node_texts(
        docs, named_by.join(some, "node", "left_semi"), id_col, text_col)
    known = WordHashes()

    def linked(a, b) -> bool:
        inter = len(np.intersect1d(a, b, assume_unique=True))
        return ratio.holds(inter, len(a) + len(b))

    labels = linking.linked_classes(members, nodes, texts_of, similarity,
                                    lambda t: shingles(t, known), linked,
                                    _accumulated(nodes, ratio))
    if labels is None:
        named = sets.withColumn("label", F.col("node"))
    else:
        named = sets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(
        F.min(F.struct(F.col("rep_id").isNull().alias("no_id"), "rep_id"))["rep_id"]
        .alias("component_id"))
    named = named.join(least, "label").select("set", "component_id")
    return rows.select("id", "set", "size").join(named, "set", "left").select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
        F.when(F.col("set").isNull(), F.col("id")).otherwise(F.col("component_id"))
        .alias("component_id"))
