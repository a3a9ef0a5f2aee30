"""Links inside buckets without all pairs of a bucket: stars, then what is still open.

Similar documents share a bucket, but a bucket may hold a third of all rows and
mostly documents of one class. Two passes settle every pair of a bucket:

1. Every member is checked against one pivot of its bucket, the member that meets
   most others, unless the bound below excludes it. That is linear in the bucket. Linked nodes form classes.
2. Pairs inside one class need no check. Members of buckets that still hold
   several classes are dealt to blocks of bounded size: the pivot's class
   meets the others, the others meet each other, and no block holds members of the
   pivot's class alone. A block compares 1024-bit parity maps of the members'
   shingles: their Hamming distance never exceeds the number of shingles that only
   one of both has, so a pair beyond what the similarity allows is excluded by
   proof. Only the pairs that remain leave a block and are checked exactly.

Beyond some 3,000 shingles such a map is full and excludes nothing, so nodes may bring a wide
map as well, a bit or two for each of their shingles: both passes put their pairs of long
texts to it, by the same bound, before any text moves.

No candidate is capped or dropped. Texts are read for nodes of pairs to check only;
a pivot's text is dealt once for every ``PER_SALT`` of its partners.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.keys import maybe_held
from basketry.llm.texts import as_bytes, chunks, mixed

BITS = 1024
BLOCK = 512
# With ``accumulate``, buckets of so many members at most are paired by size alone, as its
# bounds leave few of their pairs; the parity maps come after.
SMALL = 8
PER_SALT = 256
PART_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Ratio:
    """``inter / union >= num / den`` in whole numbers."""

    def __init__(self, similarity: float):
        exact = Fraction(similarity).limit_denominator(1_000_000)
        self.num, self.den = exact.numerator, exact.denominator

    def holds(self, inter: int, both: int) -> bool:
        """``both``: the two sizes together."""
        return inter * (self.num + self.den) >= self.num * both

    def most_apart(self, both: np.ndarray) -> np.ndarray:
        """Most shingles that only one of both may have."""
        return both * (self.den - self.num) // (self.den + self.num)


def parity_map(hashes: np.ndarray, counts: np.ndarray | None = None, bits: int = BITS) -> bytes:
    """Bit i: the parity of how many (shingle, occurrence) pairs fall on i; ``bits`` a power of two."""
    if counts is not None and len(counts) and counts.max() > 1:
        first = np.repeat(np.cumsum(counts) - counts, counts)
        turn = np.arange(len(first)) - first
        hashes = mixed(np.repeat(hashes, counts) + turn.astype(np.uint64) * _STEP)
    places = (hashes & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).tobytes()


def wide_map(hashes: np.ndarray) -> bytes | None:
    """The parity map with at least a bit for each of more than BITS hashes, else None."""
    n = len(hashes)
    return parity_map(hashes, bits=1 << (n - 1).bit_length()) if n > BITS else None


def least_apart(a: bytes, b: bytes) -> int:
    """The Hamming distance of two parity maps, the wider folded to the other's width."""
    wide = min(len(a), len(b)) // 8
    a, b = (np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, wide)) for x in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def shared_buckets(placed: DataFrame) -> DataFrame:
    """(bucket, node, n) of the buckets with n > 1 of the (bucket, node) rows, which move once."""
    n = F.count(F.lit(1)).over(Window.partitionBy("bucket"))
    return placed.select("bucket", "node", n.alias("n")).filter("n > 1")


def node_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of ``wanted`` (node, rep_id, rep_raw): each text from one row alone.

    A bit map of the wanted hashes keeps most other texts out of the shuffle. They are
    written before repeated rows go: joins on ``node`` meet the texts where that puts them.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn(
        "raw", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    source = maybe_held(source, "raw", wanted.select(F.col("rep_raw").alias("raw")))
    return (source.join(wanted, (source["raw"] == wanted["rep_raw"])
                        & source["id"].eqNullSafe(wanted["rep_id"]))
            .select("node", "text").checkpoint(eager=True).dropDuplicates(["node"]))


def classes(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes in (a, b) edges: the least node of each component.

    Each step takes the least label of a node's neighbours and then the label
    of its label; steps are checkpointed, and end when no label moves.
    """
    both = (edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"),
                                                            F.col("a").alias("b")))
            .distinct().checkpoint(eager=True))
    labels = (both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
              .select("node", F.least("node", "least").alias("label")).checkpoint(eager=True))
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("least")))
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "least").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = (lower.join(jump, "label", "left")
                 .select("node", "before", F.coalesce("next", "label").alias("label"))
                 .withColumn("label", F.least("before", "label")).checkpoint(eager=True))
        labels = moved.select("node", "label")
        if moved.filter("label != before").isEmpty():
            return labels


def linked_pairs(pairs: DataFrame, texts_of: Callable, row_of: Callable, linked: Callable) -> DataFrame:
    """The distinct (a, b) whose texts are ``linked(row_of(text_a), row_of(text_b))``.

    ``texts_of`` reads the texts of the nodes in ``pairs``, and no others. Rows come sorted
    by a, whose row is built once for a salt's partners.
    """
    pairs = pairs.select("a", "b").checkpoint(eager=True)
    texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_SALT).alias("salts"))
    salted = pairs.join(salts, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"))
    left = (salted.select("a", "salt").distinct()
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"))
    right = salted.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    joined = right.join(left.hint("merge"), ["a", "salt"]).select("a", "b", "text_a", "text_b")

    def run(batches):
        last, held = None, None
        for b in chunks(batches, "text_b", PART_BYTES):
            keep = []
            for a, ta, tb in zip(b.column(0).to_pylist(), as_bytes(b.column(2)),
                                 as_bytes(b.column(3))):
                if a != last:
                    last, held = a, row_of(ta)
                keep.append(linked(held, row_of(tb)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def _possible(ratio: Ratio):
    """Arrow function over (a, b, size_a, size_b, bits_a, bits_b): the (a, b) not excluded."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sizes = [b.column(c).to_numpy(zero_copy_only=False) for c in (2, 3)]
            maps = [np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint64).reshape(
                b.num_rows, -1) for c in (4, 5)]
            most = ratio.most_apart(sizes[0] + sizes[1])
            kept = (np.abs(sizes[0] - sizes[1]) <= most) & (
                np.bitwise_count(maps[0] ^ maps[1]).sum(axis=1) <= most)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(
                pa.array(kept, pa.bool_()))

    return run


def _possible_long(ratio: Ratio):
    """Arrow function over (a, b, both, wide_a, wide_b): the (a, b) not excluded by two wide maps."""
    def run(batches):
        for b in batches:
            kept = [x is None or y is None or least_apart(x, y) <= ratio.most_apart(both)
                    for both, x, y in zip(*(b.column(c).to_pylist() for c in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(
                pa.array(kept, pa.bool_()))

    return run


def _block_pairs(ratio: Ratio):
    """Arrow function over rows sorted by key: (a, b) not excluded, within each key."""
    names = ["a", "b"]

    def pairs(key, node, label, side, size, bits):
        at = np.arange(len(key))
        step = 0
        while True:
            step += 1
            at = at[at + step < len(key)]
            at = at[key[at + step] == key[at]]
            if not len(at):
                return
            other = at + step
            open_ = (label[at] != label[other]) & ((side[at] == 2) | (side[at] != side[other]))
            i, j = at[open_], other[open_]
            most = ratio.most_apart(size[i] + size[j])
            close = np.abs(size[i] - size[j]) <= most
            i, j, most = i[close], j[close], most[close]
            apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1)
            i, j = i[apart <= most], j[apart <= most]
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(node[i], node[j])),
                     pa.array(np.maximum(node[i], node[j]))], names)

    def columns(batch):
        whole = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(5)]
        maps = batch.column(5).to_pylist()
        wide = BITS // 64 if maps[0] is not None else 0
        flat = np.frombuffer(b"".join(maps) if wide else b"", np.uint64)
        return [*whole, flat.reshape(batch.num_rows, wide)]

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            now = columns(b)
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            ends = np.flatnonzero(now[0][1:] != now[0][:-1])
            cut = ends[-1] + 1 if len(ends) else 0  # the last key may go on
            yield from pairs(*[x[:cut] for x in now])
            held = [x[cut:] for x in now]
        if held is not None:
            yield from pairs(*held)

    return run


def _dealt(members: DataFrame, labels: DataFrame | None, nodes: DataFrame,
           small: int) -> tuple[DataFrame, DataFrame]:
    """(key, node, label, side, size, bits) rows of the blocks of buckets with several classes:
    those of small buckets, with null bits, and those of the others."""
    if labels is None:
        named = members.withColumn("label", F.col("node"))
    else:
        named = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    info = (named.groupBy("bucket")
            .agg(F.max(F.struct("degree", "node", "label"))["label"].alias("top"),
                 F.min("label").alias("low"), F.max("label").alias("high"),
                 F.count(F.lit(1)).alias("n")).filter("low != high").select("bucket", "top", "n"))
    named = named.join(info, "bucket").withColumn("is_top", F.col("label") == F.col("top"))
    large = named.filter(F.col("n") > BLOCK)
    blocks = large.groupBy("bucket").agg(
        F.greatest(F.lit(1), F.ceil(F.count_if("is_top") / BLOCK)).cast("int").alias("n_top"),
        F.greatest(F.lit(1), F.ceil(F.count_if(~F.col("is_top")) / BLOCK)).cast("int").alias("n_rest"))
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.when(F.col("is_top"), F.col("n_top"))
                 .otherwise(F.col("n_rest"))).cast("int")

    def place(kind: int, i: Column, j: Column, side: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"),
                        side.cast("int").alias("side"))

    def every(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    of_top = F.transform(every("n_rest"), lambda j: place(0, F.col("own"), j, F.lit(0)))
    of_rest = F.concat(
        F.transform(every("n_top"), lambda i: place(0, i, F.col("own"), F.lit(1))),
        F.transform(every("n_rest"), lambda j: place(
            1, F.least("own", j), F.greatest("own", j),
            F.when(j == F.col("own"), F.lit(2)).otherwise((F.col("own") < j).cast("int")))))
    split = (large.join(blocks, "bucket").withColumn("own", own)
             .withColumn("at", F.explode(F.when(F.col("is_top"), of_top).otherwise(of_rest)))
             .select(F.xxhash64("bucket", "at.kind", "at.i", "at.j").alias("key"), "node", "label",
                     F.col("at.side").alias("side")))
    def whole(least: int, most: int) -> DataFrame:
        return named.filter((F.col("n") > least) & (F.col("n") <= most)).select(
            F.xxhash64("bucket").alias("key"), "node", "label", F.lit(2).alias("side"))

    def with_sizes(rows: DataFrame, bits: Column) -> DataFrame:
        sized = nodes.select("node", F.col("size").cast("long").alias("size"), bits.alias("bits"))
        return (rows.join(sized, "node").select("key", "node", "label", "side", "size", "bits")
                .repartition("key").sortWithinPartitions("key"))

    return (with_sizes(whole(0, small), F.lit(None).cast("binary")),
            with_sizes(whole(small, BLOCK).unionByName(split), F.col("bits")))


def linked_classes(members: DataFrame, nodes: DataFrame, texts_of: Callable, similarity: float,
                   row_of: Callable, linked: Callable,
                   accumulate: Callable | None = None) -> DataFrame | None:
    """(node, label) of all nodes that are linked inside buckets, None where none is.

    ``members``: (bucket, node, n) with the bucket's size n > 1; ``nodes``: (node, size, bits) and,
    where there are such, the ``wide`` map or null;
    ``texts_of``: the (node, text) rows of a frame of nodes.
    ``accumulate`` takes the open pairs of pass 2, one row for each bucket they share, and
    returns the distinct ones that its own bounds leave.
    """
    ratio = Ratio(similarity)
    degree = members.groupBy("node").agg(F.sum("n").alias("degree"))
    members = members.join(degree, "node").select("bucket", "node", "degree").checkpoint(eager=True)
    pivots = members.groupBy("bucket").agg(
        F.max(F.struct("degree", "node"))["node"].alias("pivot"))
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"),
                                  F.col("bits").alias(f"bits_{c}"))

    def bounded(pairs: DataFrame) -> DataFrame:
        return (pairs.join(side("b"), "b").join(side("a"), "a")
                .select("a", "b", F.col("size_a").cast("long"), F.col("size_b").cast("long"),
                        "bits_a", "bits_b").mapInArrow(_possible(ratio), "a long, b long"))

    def sharper(pairs: DataFrame) -> DataFrame:
        if "wide" not in nodes.columns:
            return pairs
        pairs = pairs.select("a", "b").checkpoint(eager=True)
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
        long = maybe_held(nodes.filter("wide is not null").select("node", "size", "wide"), "node", ends)
        for c in ("b", "a"):
            pairs = pairs.join(long.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"),
                                           F.col("wide").alias(f"wide_{c}")), c, "left")
        return pairs.select("a", "b", (F.col("size_a") + F.col("size_b")).cast("long").alias("both"),
                            "wide_a", "wide_b").mapInArrow(_possible_long(ratio), "a long, b long")

    stars = (members.join(pivots, "bucket").filter("node != pivot")
             .select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
    stars = bounded(stars)
    # (p, x) and (x, p) may both come, where each is a pivot: once is enough.
    stars = stars.groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(
        F.max("a").alias("a")).select("a", (F.col("lo") + F.col("hi") - F.col("a")).alias("b"))
    edges = linked_pairs(sharper(stars), texts_of, row_of, linked).checkpoint(eager=True)
    labels = None if edges.isEmpty() else classes(edges)
    small, large = (rows.mapInArrow(_block_pairs(ratio), "a long, b long") for rows in _dealt(
        members, labels, nodes, min(SMALL, BLOCK) if accumulate else 0))
    if accumulate is None:
        rest = large.distinct()
    else:
        rest = bounded(accumulate(small.unionByName(large)))
    more = linked_pairs(sharper(rest), texts_of, row_of, linked).checkpoint(eager=True)
    if more.isEmpty():
        return labels
    return classes(edges.unionByName(more))
