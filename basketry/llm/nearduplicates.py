"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, bands, exact checks.

A document is the multiset of its five-word shingles (a shorter text is one
shingle). Weights are discretised at 1, 2, 4, 8, ...: every shingle runs one
Poisson process per level (0, 1], (1, 2], (2, 4], ..., of the level's rate;
each point falls into one register, and a level the weight covers only in part
keeps a point when its place inside the level, found by halving, lies below
the weight. A register keeps its first point, so two documents agree in a
register with probability sum(min) / sum(max). Points come in ascending order
and stop at a horizon where all registers are filled (doubled where not),
which costs about ``REGISTERS * log(REGISTERS)`` points whatever the length.

Texts with equal words are one node. Nodes with an equal band share a bucket, and
``linking`` settles all pairs of a bucket: every member against one pivot first, then
the pairs of different classes that a bound on their shingles in common leaves open,
each checked by exact multiset overlap. Linked nodes form classes by label
propagation.

Texts without words (null, empty, punctuation) are never duplicates: each row
is a class of its own. Null ids take part; a class is named by its smallest
non-null id. Repeated rows are copies like any other. Extra columns are ignored
(``drop_near_duplicates`` keeps them).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.linking import Ratio, linked_classes, node_texts, parity_map, shared_buckets
from basketry.llm.texts import WordHashes, as_bytes, chunks, mixed, words
from basketry.session import checkpoint_root

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 8
REGISTERS = BANDS * ROWS
PART_BYTES = 1 << 20
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def bag(word_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and their counts."""
    n = len(word_hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    span = min(SHINGLE, n)
    h = np.full(n - span + 1, span, np.uint64)
    for i in range(span):
        h = (h ^ word_hashes[i:n - span + 1 + i]) * _B
        h ^= h >> np.uint64(32)
    return np.unique(mixed(h), return_counts=True)


def overlap(a, b) -> float:
    """Weighted Jaccard of two bags: sum of minima by sum of maxima."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    return low / max(int(a[1].sum() + b[1].sum()) - low, 1)


def _levels(weight: np.ndarray):
    """(element, low, high) of every level a weight reaches."""
    parts = [(np.arange(len(weight)), 0, 1)]
    high = 1
    while True:
        reach = np.flatnonzero(weight > high)
        if not len(reach):
            break
        parts.append((reach, high, high * 2))
        high *= 2
    element = np.concatenate([p[0] for p in parts])
    low = np.concatenate([np.full(len(p[0]), p[1], np.int64) for p in parts])
    return element, low, np.where(low == 0, 1, low * 2)


def signatures(bags: list, registers: int = REGISTERS) -> np.ndarray:
    """(documents, registers) hashes of each register's first point."""
    out = np.zeros((len(bags), registers), np.uint64)
    total = np.array([b[1].sum() for b in bags], float)
    todo = np.flatnonzero(total)
    horizon = (math.log(registers) + 5) / np.maximum(total, 1)
    while len(todo):
        first = _first_points([bags[d] for d in todo], horizon[todo], registers)
        out[todo] = first[1]
        todo = todo[np.isinf(first[0]).any(axis=1)]
        horizon[todo] *= 2
    return out


def _first_points(bags: list, horizon: np.ndarray, registers: int):
    sizes = [len(b[0]) for b in bags]
    shingle = np.concatenate([b[0] for b in bags])
    weight = np.concatenate([b[1] for b in bags])
    owner = np.repeat(np.arange(len(bags)), sizes)
    element, low, high = _levels(weight)
    seed = mixed(shingle[element] + high.astype(np.uint64) * _A)
    weight, owner = weight[element], owner[element]
    rate, limit = (high - low) * float(registers), horizon[owner]
    time = np.zeros(len(seed))
    best = np.full(len(bags) * registers, np.inf)
    point_of = np.zeros(len(best), np.uint64)
    turn = 0
    while len(seed):
        turn += 1
        h = mixed(seed + np.uint64(turn * int(_C) & (1 << 64) - 1))
        # The gap to the process's next point; (h >> 11) + 0.5 keeps the logarithm finite.
        time = time - np.log(((h >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) / rate
        live = time <= limit
        seed, weight, owner, low, high, rate, limit, time, h = (
            v[live] for v in (seed, weight, owner, low, high, rate, limit, time, h))
        kept = np.ones(len(h), bool)
        part = np.flatnonzero(weight < high)
        if len(part):  # the place inside the level, high bits first: a walk down its halves
            inside = (mixed(h[part] + _A) % (high - low)[part].astype(np.uint64)).astype(np.int64)
            kept[part] = low[part] + inside < weight[part]
        point = mixed(h ^ _B)
        cell = owner * registers + (point % np.uint64(registers)).astype(np.int64)
        better = np.flatnonzero(kept & (time < best[cell]))
        cell, at, point = cell[better], time[better], point[better]
        np.minimum.at(best, cell, at)
        wins = best[cell] == at
        point_of[cell[wins]] = point[wins]
    return best.reshape(-1, registers), point_of.reshape(-1, registers)


def signed_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, raw, words, size, bits, bands): hashes of text and words (null without words), bag
    size, parity map and band hashes."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("raw", T.BinaryType()),
        T.StructField("words", T.BinaryType()), T.StructField("size", T.LongType()),
        T.StructField("bits", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        known = WordHashes()
        for b in chunks(batches, "text", PART_BYTES):
            raw = as_bytes(b.column(1))
            split = [words(t) for t in raw]
            bags = [bag(known.of(w)) for w in split]
            sig = signatures(bags)
            band = np.full((len(raw), BANDS), 1, np.uint64)
            for r in range(ROWS):
                band = (band ^ sig[:, r::ROWS]) * _B
                band ^= band >> np.uint64(29)
            band = mixed(band + np.arange(BANDS, dtype=np.uint64) * _A).view(np.int64)
            ends = np.arange(len(raw) + 1, dtype=np.int32) * BANDS
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([hashlib.md5(t).digest() for t in raw], pa.binary()),
                pa.array([hashlib.md5(b" ".join(w)).digest() if w else None for w in split],
                         pa.binary()),
                pa.array([int(x[1].sum()) for x in bags], pa.int64()),
                pa.array([parity_map(*x) for x in bags], pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(band.ravel()))], schema.names)

    return rows.mapInArrow(run, schema)


def _nodes(docs: DataFrame, id_col: str, text_col: str, similarity: float):
    """(rows, nodes): checkpointed (id, raw, words) rows, and (words, label, rep, n_rows)."""
    checkpoint_root(docs.sparkSession)
    rows = (signed_documents(docs, id_col, text_col)
            .withColumn("row", F.monotonically_increasing_id()).checkpoint(eager=True))
    # A node is named by the row of its least id.
    nodes = (rows.filter("words is not null").groupBy("words")
             .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "raw", "row")).alias("rep"),
                  F.count(F.lit(1)).alias("n_rows"))
             .withColumn("node", F.col("rep.row")).checkpoint(eager=True))
    reps = rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").select(
        F.col("row").alias("node"), "id", "raw", "size", "bits", "bands")
    banded = reps.select("node", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("bucket"), "node")
    members = shared_buckets(banded).checkpoint(eager=True)
    wanted = (reps.drop("bands").join(members.select("node").distinct(), "node", "left_semi")
              .checkpoint(eager=True))
    named_by = wanted.select("node", F.col("id").alias("rep_id"), F.col("raw").alias("rep_raw"))
    texts_of = lambda some: node_texts(
        docs, named_by.join(some, "node", "left_semi"), id_col, text_col)
    known, ratio = WordHashes(), Ratio(similarity)

    def linked(a, b) -> bool:
        _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
        return ratio.holds(int(np.minimum(a[1][i], b[1][j]).sum()), int(a[1].sum() + b[1].sum()))

    labels = linked_classes(members, wanted, texts_of, similarity,
                            lambda t: bag(known.of(words(t))), linked)
    if labels is None:
        named = nodes.withColumn("label", F.col("node"))
    else:
        named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return rows, named.select("words", "label", "rep", "n_rows").checkpoint(eager=True)


def near_duplicate_classes(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """(id, class_id, class_size) of every row; class_id is the least id of the class."""
    rows, nodes = _nodes(docs, id_col, text_col, similarity)
    classes = nodes.groupBy("label").agg(F.min("rep").alias("least"),
                                         F.sum("n_rows").alias("class_size"))
    named = nodes.select("words", "label").join(classes, "label").select(
        "words", F.col("least.id").alias("class_id"), "class_size")
    return (rows.select("id", "words").join(named, "words", "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("class_size").isNull(), F.col("id")).otherwise(F.col("class_id"))
                    .alias("class_id"),
                    F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size")))


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """One row of each class (the least id's), and every row without words; all columns."""
    rows, nodes = _nodes(docs, id_col, text_col, similarity)
    best = nodes.groupBy("label").agg(F.min("rep").alias("rep")).select(
        F.col("rep.id").alias("k_id"), F.col("rep.raw").alias("k_raw"))
    # Rows equal in id and text: one of them stays.
    again = (rows.filter("words is not null").groupBy("id", "raw").agg(F.count(F.lit(1)).alias("n")))
    keys = best.join(again, F.col("k_id").eqNullSafe(F.col("id")) & (F.col("k_raw") == F.col("raw"))) \
        .select("k_id", "k_raw", (F.col("n") > 1).alias("again"))
    wordless = rows.filter("words is null").select(
        F.col("id").alias("k_id"), F.col("raw").alias("k_raw"), F.lit(False).alias("again")).distinct()
    keys = keys.unionByName(wordless).checkpoint(eager=True)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
        F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).alias("raw"))

    def chosen(which: DataFrame) -> DataFrame:
        return packed.join(which, F.col("id").eqNullSafe(F.col("k_id"))
                           & (F.col("raw") == F.col("k_raw")), "left_semi")

    out = chosen(keys.filter("not again"))
    repeated = keys.filter("again")
    if not repeated.isEmpty():
        out = out.unionByName(chosen(repeated).dropDuplicates(["id", "raw"]))
    return out.select("row.*")
