"""Prefix trie of conversations, rolled up in depth bands.

Conversations are rebuilt first: conversation ``c`` starts with the first ``h``
turns of conversation ``c - c % 20`` (``h`` = crc32 of its decimal id mod 4) and
goes on with its own turns after its first ``h``. A node is a distinct sequence of
first ``d`` turns. Its key is the exclusive or of 128-bit hashes of (place, role,
text) over those turns, a running total that needs no walk along the
conversation: totals of sixteen turns, of sixteen such blocks, and so on give
every block's start, so that a conversation of any length is spread over tasks.

Subtree sums need each node's ancestors. A node explodes only to the ancestors in
its own band of ``HEIGHT`` depths, which are turns of the conversation that names
it. Totals of completed bands stand at their roots, and the roots are a trie
``HEIGHT`` times lower, which is rolled up the same way; on the way back a band
root adds its whole total to its ancestors in the band above. A node is exploded
to at most ``2 * HEIGHT`` rows a level, and there are log(depth) levels.

The hash of the conversations that end at a node runs over their sorted ids. Ids
are numbered within nodes by range partitions, joined to chunks, and the chunks
of a node are hashed one after another as a stream.

Rows without a conv_id belong to no conversation and are left out. Turns are
ordered by turn (null first); ties by role and text; repeated rows are turns of
their own. Null role or text becomes empty. A conversation whose turns are all
cut is a member of the root alone. An empty table has no root and gives no rows;
extra columns are ignored. Texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.ranking import position_in_groups
from basketry.session import checkpoint_root

HEIGHT = 16
CHUNK_IDS = 4096
GROUP, MAX_SHARED = 20, 4
KEY = ["k1", "k2"]
NODE = ["depth", "k1", "k2"]
_WORD = r"[^\x20\x09-\x0D]+"


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes over."""
    return (F.crc32(conv.cast("string").cast("binary")) % MAX_SHARED).cast("int")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, role, text) of the rebuilt turns, depth from 1, and all (conv)."""
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    numbered = (position_in_groups(rows, ["conv"], [F.col("turn").asc_nulls_first(), "role", "text"],
                                   "place")
                .select("conv", "place", "role", "text"))
    convs = numbered.select("conv").distinct()
    own = numbered.filter(F.col("place") > shared_turns(F.col("conv"))).withColumn(
        "start", shared_turns(F.col("conv")))
    wanted = convs.select("conv", (F.col("conv") - F.col("conv") % GROUP).alias("base"),
                          shared_turns(F.col("conv")).alias("h"))
    first = numbered.filter(F.col("place") < MAX_SHARED).select(
        F.col("conv").alias("base"), "place", "role", "text")
    taken = (wanted.filter("h > 0").join(first, "base").filter("place <= h")
             .select("conv", F.col("place").alias("depth"), "role", "text"))
    # Own turns follow on the turns that were there to take.
    n_taken = (numbered.filter(F.col("place") < MAX_SHARED).groupBy(F.col("conv").alias("base"))
               .agg(F.count(F.lit(1)).alias("held")))
    offsets = (wanted.join(n_taken, "base", "left")
               .select("conv", F.least("h", F.coalesce("held", F.lit(0))).alias("n_taken")))
    kept = own.join(offsets, "conv").select(
        "conv", (F.col("place") - F.col("start") + F.col("n_taken")).alias("depth"), "role", "text")
    return taken.unionByName(kept), convs


def _running(turns: DataFrame, place: str, deepest: int) -> DataFrame:
    """``turns`` with k1, k2: exclusive or of h1, h2 up to each place (from 1) of a conv."""
    block = F.floor((F.col(place) - 1) / HEIGHT).cast("long")
    here = (Window.partitionBy("conv", "block").orderBy(place)
            .rowsBetween(Window.unboundedPreceding, 0))
    inside = turns.withColumn("block", block).withColumns(
        {k: F.bit_xor(h).over(here) for k, h in zip(KEY, ("h1", "h2"))})
    if deepest <= HEIGHT:
        return inside.drop("block")
    totals = (turns.withColumn("block", block).groupBy("conv", "block")
              .agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
              .withColumn("rank", F.col("block") + 1))
    upper = _running(totals, "rank", (deepest + HEIGHT - 1) // HEIGHT)
    before = upper.select("conv", F.col("rank").alias("block"), F.col("k1").alias("b1"),
                          F.col("k2").alias("b2"))
    return (inside.join(before, ["conv", "block"], "left")
            .withColumns({k: F.col(k).bitwiseXOR(F.coalesce(b, F.lit(0).cast("long")))
                          for k, b in zip(KEY, ("b1", "b2"))})
            .drop("block", "b1", "b2"))


def paths(conversations: DataFrame) -> tuple[DataFrame, int]:
    """(conv, depth, k1, k2, p1, p2, words, ends) of every conversation's nodes, and the depth.

    Depth 0 is the root; ``ends`` marks a conversation's last node.
    """
    checkpoint_root(conversations.sparkSession)
    turns, convs = rebuilt(conversations)
    hashed = turns.select(
        "conv", F.col("depth").cast("long").alias("depth"),
        F.xxhash64(F.lit(1), "depth", "role", F.lit("\x00"), "text").alias("h1"),
        F.xxhash64(F.lit(2), "text", F.lit("\x00"), "role", "depth").alias("h2"),
        F.regexp_count("text", F.lit(_WORD)).cast("long").alias("words")).checkpoint(eager=True)
    deepest = hashed.agg(F.max("depth")).first()[0] or 0
    lengths = convs.join(hashed.groupBy("conv").agg(F.max("depth").alias("length")), "conv", "left")
    lengths = lengths.select("conv", F.coalesce("length", F.lit(0).cast("long")).alias("length"))
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"),
                         zero.alias("p1"), zero.alias("p2"), zero.alias("words"))
    below = _running(hashed, "depth", deepest).select(
        "conv", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"),
        F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"), "words")
    rows = roots.unionByName(below).join(lengths, "conv").withColumn(
        "ends", F.col("depth") == F.col("length")).drop("length")
    return rows.checkpoint(eager=True), deepest


def _stream_hashes(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of nodes where conversations end; ``ends``: (node, conv)."""
    placed = position_in_groups(ends.select(*NODE, "conv"), NODE, ["conv"], "place")
    chunks = (placed.withColumn("chunk", F.floor((F.col("place") - 1) / CHUNK_IDS))
              .groupBy(*NODE, "chunk")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")),
                                            lambda c: c.cast("string")), ",").alias("ids")))

    def run(batches):
        key = state = None
        for b in batches:
            out = []
            for *node, ids in zip(*(b.column(i).to_pylist() for i in range(4))):
                if node != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
        if key is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (*key, state.hexdigest())], names)

    names = [*NODE, "ends_sha256"]
    ordered = (chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk")
               .select(*NODE, "ids"))
    return ordered.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def _totals(values: DataFrame, turns: DataFrame, stride: int, above: int, names: list[str]):
    """Sums of ``values`` (conv, node, names) at the ancestors of their band, or of the band above.

    Ancestors are the turns of ``conv`` whose depth is a multiple of ``stride``.
    """
    span = stride * HEIGHT
    band = F.floor(F.col("depth") / span).cast("long")
    who = values.select("conv", (band - above).alias("band"), F.col("depth").alias("from"), *names)
    steps = turns.filter(F.col("depth") % stride == 0).withColumn("band", band)
    return (steps.join(who, ["conv", "band"]).filter(F.col("depth") <= F.col("from"))
            .groupBy(*NODE).agg(*[F.sum(n).alias(n) for n in names]))


def subtree_sums(nodes: DataFrame, turns: DataFrame, deepest: int, names: list[str]) -> DataFrame:
    """(depth, k1, k2, names) with the sums of ``names`` over every node's subtree.

    ``nodes``: (conv, depth, k1, k2, names), where ``conv`` passes through the node.
    """
    who = nodes.select("conv", *NODE)
    levels, stride = [], 1
    values = nodes.select("conv", *NODE, *names)
    while True:
        own = _totals(values, turns, stride, 0, names).checkpoint(eager=True)
        levels.append((stride, own))
        stride *= HEIGHT
        if deepest < stride:
            break
        values = own.filter(F.col("depth") % stride == 0).join(who, NODE)
    whole = levels[-1][1]
    for stride, own in reversed(levels[:-1]):
        roots = whole.filter(F.col("depth") >= stride * HEIGHT).join(who, NODE)
        more = _totals(roots, turns, stride, 1, names)
        whole = (own.unionByName(more).groupBy(*NODE)
                 .agg(*[F.sum(n).alias(n) for n in names]).checkpoint(eager=True))
    return whole


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node, named by its smallest member and its depth."""
    steps, deepest = paths(conversations)
    nodes = (steps.groupBy(*NODE)
             .agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"),
                  F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
             .checkpoint(eager=True))
    children = (nodes.filter("depth > 0")
                .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"),
                         F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children")))
    nodes = (nodes.join(children, NODE, "left")
             .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
             .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
             .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words"))
             .checkpoint(eager=True))
    # Only the conversations that name a node serve as paths to its ancestors.
    naming = steps.join(nodes.select("conv").distinct(), "conv", "left_semi").select("conv", *NODE)
    sums = subtree_sums(nodes, naming, deepest, ["n_leaves", "saved_tokens"])
    ended = _stream_hashes(steps.filter("ends"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"),
                           F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    return (nodes.drop("n_leaves", "saved_tokens").join(sums, NODE)
            .join(ended, NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
                    "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
                    .alias("ends_sha256")))
