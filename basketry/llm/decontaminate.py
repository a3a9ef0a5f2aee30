"""Benchmark decontamination with suffix arrays over the training text.

Training documents are cut into shards (bounded chunks of whole documents
inside a task). A shard's words become numbers of the benchmark vocabulary (0:
a word no item has, or a document's end) and its suffixes are sorted by their
first four words, packed into one integer. Every benchmark suffix is
binary-searched in that order; only groups that some suffix reached are sorted
by the next four words, and so on through the window (most significant words
first). What is left after the last word are exactly the places where a window
stands; places that continue each other are joined into longest matches.

A window is ``window`` consecutive words of an item; an item with fewer words,
but not none, is one window. The benchmark is cut into blocks of bounded size,
each shipped to the tasks in one pass over the documents; one block is usual.
Long items are cut with ``window - 1`` words of overlap, so no window is lost.

Null text has no words: no match, never contaminated. Repeated rows and null
ids each get their own row; duplicate items all count by their item_id, an item with
null id is skipped. An empty benchmark contaminates nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.texts import as_bytes, chunks, words

WINDOW = 13
STEP = 4                 # words packed into one 64-bit key, 16 bits each
BLOCK_WORDS = 1 << 15    # words of benchmark text in a block: ids fit 16 bits
SHARE = 20               # contaminated when 20 * n_hit >= n_words
_FIELDS = [("item", pa.string()), ("item_start", pa.int64()),
           ("doc_start", pa.int64()), ("n_words", pa.int64())]
_MATCH = T.StructType([T.StructField("item", T.StringType()),
                       *(T.StructField(n, T.LongType()) for n, _ in _FIELDS[1:])])


@dataclass
class Block:
    """Windows of some item pieces, one row per benchmark suffix, in sorted order."""

    vocabulary: dict
    ids: np.ndarray        # word numbers of all pieces, pieces apart by a 0
    starts: np.ndarray     # suffix -> place in ids
    length: np.ndarray     # suffix -> words of its window
    piece: np.ndarray      # suffix -> piece
    names: list            # piece -> item id
    offset: np.ndarray     # piece -> first word within its item
    base: np.ndarray       # piece -> place in ids


def _blocks(items, window: int):
    """Blocks from (item id, text) rows; items stream through, one block is held."""
    pieces, held = [], 0
    for name, text in items:
        if name is None:
            continue
        w = words((text or "").encode())
        at = 0
        while at < len(w):
            part = w[at:at + BLOCK_WORDS // 4]
            if held + len(part) + 1 > BLOCK_WORDS and pieces:
                yield _block(pieces, window)
                pieces, held = [], 0
            pieces.append((str(name), at, part, len(w)))
            held += len(part) + 1
            if at + len(part) >= len(w):
                break
            at += len(part) - (window - 1)
    if pieces:
        yield _block(pieces, window)


def _block(pieces, window: int) -> Block:
    vocabulary: dict = {}
    ids, starts, length, owner, base = [], [], [], [], []
    for p, (_, _, part, whole) in enumerate(pieces):
        base.append(len(ids))
        n = min(window, whole)
        starts += range(len(ids), len(ids) + len(part) - n + 1)
        length += [n] * (len(part) - n + 1)
        owner += [p] * (len(part) - n + 1)
        ids += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in part]
        ids.append(0)
    return Block(vocabulary, np.array(ids, np.int64), np.array(starts, np.int64),
                 np.array(length, np.int64), np.array(owner, np.int64),
                 [p[0] for p in pieces], np.array([p[1] for p in pieces], np.int64),
                 np.array(base, np.int64))


def _keys(ids: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Words depth .. depth + STEP of the suffixes at ``places`` as one integer."""
    key = np.zeros(len(places), np.uint64)
    for j in range(STEP):
        key = (key << np.uint64(16)) | ids[places + depth + j].astype(np.uint64)
    return key


def _occurrences(shard: np.ndarray, block: Block, window: int):
    """(place in the shard, benchmark suffix) of every window found in the shard."""
    pad = np.zeros(window + STEP, np.int64)
    shard, bench = np.concatenate([shard, pad]), np.concatenate([block.ids, pad])
    places = np.flatnonzero(shard[:len(shard) - len(pad)])
    group = np.zeros(len(places), np.int64)      # suffixes equal so far share a group
    tests = np.arange(len(block.starts))
    test_group = np.zeros(len(tests), np.int64)
    found_places, found_tests = [], []
    for depth in range(0, window, STEP):
        if not len(places) or not len(tests):
            break
        keys = _keys(shard, places, depth)
        order = np.lexsort((keys, group)) if depth else np.argsort(keys)
        places, keys, group = places[order], keys[order], group[order]
        # Words of the window in this step; the rest of the key may be anything.
        left = np.clip(block.length[tests] - depth, 0, STEP)
        low_bits = np.minimum((STEP - left) * 16, 48).astype(np.uint64)
        test_keys = _keys(bench, block.starts[tests] , depth) >> low_bits << low_bits
        top = test_keys + ((np.uint64(1) << low_bits) - np.uint64(1))
        lo = _search(group, keys, test_group, test_keys, "left")
        hi = _search(group, keys, test_group, top, "right")
        done = (block.length[tests] <= depth + STEP) & (hi > lo)
        count = (hi - lo)[done]
        found_tests.append(np.repeat(tests[done], count))
        found_places.append(places[_ranges(lo[done], count)])
        # Only groups that an unfinished test suffix reached are refined further.
        more = (block.length[tests] > depth + STEP) & (hi > lo)
        tests, lo, hi = tests[more], lo[more], hi[more]
        reached, test_group = np.unique(lo, return_inverse=True)
        ends = np.zeros(len(reached), np.int64)
        ends[test_group] = hi
        count = ends - reached
        places = places[_ranges(reached, count)]
        group = np.repeat(np.arange(len(reached)), count)
    if not found_places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_places), np.concatenate(found_tests)


def _search(group, keys, test_group, test_keys, side):
    """Binary search of (group, key) in the arrays sorted by (group, key)."""
    if not len(group) or group[-1] == 0:
        return np.searchsorted(keys, test_keys, side)
    # One rank for equal (group, key) pairs of both sides keeps the search on integers.
    n = len(keys)
    both_g, both_k = np.concatenate([group, test_group]), np.concatenate([keys, test_keys])
    order = np.lexsort((both_k, both_g))
    change = np.empty(len(order), bool)
    change[0] = True
    g, k = both_g[order], both_k[order]
    change[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(change)
    return np.searchsorted(rank[:n], rank[n:], side)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every (start, count), one after another."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before - starts, counts)


def _longest(places, tests, block: Block):
    """Matches (piece, item start, shard start, words): runs of windows on one diagonal."""
    if not len(places):
        return []
    suffix = block.starts[tests]
    diagonal = places - suffix
    order = np.lexsort((places, block.piece[tests], diagonal))
    places, suffix, diagonal, tests = places[order], suffix[order], diagonal[order], tests[order]
    piece = block.piece[tests]
    new = np.ones(len(places), bool)
    new[1:] = ((diagonal[1:] != diagonal[:-1]) | (piece[1:] != piece[:-1])
               | (places[1:] != places[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(places)) - 1
    size = places[last] + block.length[tests[last]] - places[first]
    own = piece[first]
    return list(zip(own.tolist(), (block.offset[own] + suffix[first] - block.base[own]).tolist(),
                    places[first].tolist(), size.tolist()))


def _pass(block: Block, window: int, id_col: str, text_col: str, carried: bool):
    """The Arrow function of one pass: appends this block's matches to each row."""
    match_type = pa.list_(pa.struct(_FIELDS))

    def run(batches):
        for b in chunks(batches, text_col):
            split = [words(t) for t in as_bytes(b.column(text_col))]
            sizes = np.array([len(w) + 1 for w in split], np.int64)
            base = np.cumsum(sizes) - sizes
            get = block.vocabulary.get
            shard = np.zeros(int(sizes.sum()), np.int64)
            for at, w in zip(base.tolist(), split):
                shard[at:at + len(w)] = np.fromiter((get(x, 0) for x in w), np.int64, len(w))
            found = (b.column("matches").to_pylist() if carried
                     else [[] for _ in range(b.num_rows)])
            found = [list(f or []) for f in found]
            for piece, item_start, place, size in _longest(
                    *_occurrences(shard, block, window), block):
                row = int(np.searchsorted(base, place, "right")) - 1
                found[row].append({"item": block.names[piece], "item_start": item_start,
                                   "doc_start": place - int(base[row]), "n_words": size})
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), b.column(text_col),
                 pa.array([len(w) for w in split], pa.int64()), pa.array(found, match_type)],
                [id_col, text_col, "n_words", "matches"])

    return run


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id") -> DataFrame:
    """(id, text, n_words, matches) of every row; matches: longest verbatim runs of
    benchmark windows (item, item_start, doc_start, n_words), words counted from 0.

    The item rows stream through the driver block by block, one bounded block
    at a time, and each block is one more pass chained to the last: the text
    is carried along and nothing is shuffled.
    """
    rows = docs.select(id_col, text_col)
    schema = T.StructType([rows.schema[id_col], rows.schema[text_col],
                           T.StructField("n_words", T.LongType()),
                           T.StructField("matches", T.ArrayType(_MATCH))])
    items = ((r[0], r[1]) for r in benchmark.select(item_col, "text").toLocalIterator())
    out, carried = rows, False
    for block in _blocks(items, window):
        out = out.mapInArrow(_pass(block, window, id_col, text_col, carried), schema)
        carried = True
    if not carried:
        empty = _block([], window)
        out = out.mapInArrow(_pass(empty, window, id_col, text_col, False), schema)
    return out


def n_hit(matches: str = "matches") -> Column:
    """Words covered by at least one match: runs merged in order of their start."""
    return F.expr(f"""aggregate(
        array_sort(transform({matches}, m -> struct(m.doc_start as s, m.doc_start + m.n_words as e))),
        named_struct('n', 0L, 'upto', 0L),
        (a, r) -> named_struct('n', a.n + greatest(r.e - greatest(r.s, a.upto), 0L),
                               'upto', greatest(a.upto, r.e)),
        a -> a.n)""")


def items_of(matches: str = "matches") -> Column:
    """Sorted distinct item ids."""
    return F.expr(f"array_sort(array_distinct(transform({matches}, m -> m.item)))")


def contaminated(hit: str = "n_hit", total: str = "n_words", share: int = SHARE) -> Column:
    return (F.col(hit) > 0) & (F.col(hit) * share >= F.col(total))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  share: int = SHARE, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``find_matches`` with n_hit, items and the contamination verdict."""
    return (find_matches(docs, benchmark, window, id_col, text_col)
            .withColumn("n_hit", n_hit()).withColumn("items", items_of())
            .withColumn("contaminated", contaminated(share=share)))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        share: int = SHARE, text_col: str = "text") -> DataFrame:
    """``docs`` without the affected rows, all columns as they were."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(f"`{text_col}`").alias("text"))
    judged = contamination(packed, benchmark, window, share, id_col="row")
    return judged.filter(~F.col("contaminated")).select("row.*")
