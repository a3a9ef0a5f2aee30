"""Repeated byte strings by depth-limited most-significant-digit radix passes.

Every start of a ``threshold``-byte string is a suffix that matters through its
first ``threshold`` bytes only. Suffixes are ordered by digits, most
significant first, and a group that one digit has made single is never looked
at again; groups equal through the last digit are exactly the repeated strings.

So that a pass does not move a row per byte, neighbouring suffixes travel
together. A suffix's anchor is the smallest-hash ``GRAM``-byte gram inside its
string (the leftmost of equals), a choice that depends on the string alone:
equal strings have equal anchors at equal offsets. The passes are

1. one row per run of suffixes with the same anchor place; digit: the anchor,
2. rows for ``CLASS`` offsets to the anchor each; digit: the bytes all their
   strings share,
3. one row per suffix; digit: its whole string.

Each row also carries a hash of its *span*, all bytes of its run. Rows with
equal digit and equal span have pairwise equal strings, so they are settled at
once (copies never reach the next pass); rows whose digit is unique are done;
only rows with a shared digit and an own span go on, together with one
representative of each repeated span. All grouping is hash aggregation with
partial counts before the shuffle, so a passage in a third of all documents is
a few rows per task. (digit, span) are 128 bits of independent hashes.

Null text is empty; texts below ``threshold`` bytes keep everything. Results
depend on the text alone, rows are joined by a 128-bit text hash, so repeated
rows and null ids keep their rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.texts import as_bytes, chunks, mixed
from basketry.session import checkpoint_root

THRESHOLD = 200
GRAM = 64
CLASS = 16
PART_BYTES = 1 << 20
_ROW = "core long, span long, key binary, place long"
_NAMES = ["core", "span", "key", "place"]
# A row's place packs anchor << 16 | (anchor - first start) << 8 | (last - first start).
SETTLED, OPEN, BOTH = 1, 2, 3


class _Grams:
    """Hashes of all GRAM-byte strings: prefix sums of a polynomial modulo 2 ** 64."""

    def __init__(self):
        rng = np.random.default_rng(0x5EED)
        self.byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = 0x9E3779B97F4A7C15 | 3
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        while len(self.powers) < n:
            k = len(self.powers)
            self.powers = np.concatenate([self.powers, self.powers * np.uint64(
                pow(self.base, k, 1 << 64))])
            self.inverses = np.concatenate([self.inverses, self.inverses * np.uint64(
                pow(self.inverse, k, 1 << 64))])

    def of(self, x: np.ndarray) -> np.ndarray:
        n = len(x) - GRAM + 1
        self._grow(len(x))
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(self.byte[x] * self.powers[:len(x)], out=sums[1:])
        return mixed((sums[GRAM:] - sums[:n]) * self.inverses[:n])


def runs(raw: list[bytes], grams: _Grams, threshold: int):
    """(doc, anchor, first, last, gram hash) arrays: runs of suffixes with one anchor.

    Places are relative to the document.
    """
    sizes = np.array([len(t) for t in raw], np.int64)
    starts = np.cumsum(sizes) - sizes
    x = np.frombuffer(b"".join(raw), np.uint8)
    if len(x) < threshold:
        return None
    h = grams.of(x)
    width = threshold - GRAM + 1
    # High half of the hash, then the place: the minimum is the leftmost smallest gram.
    low = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while step * 2 <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    low = np.minimum(low[:len(h) - width + 1], low[width - step:][:len(h) - width + 1])
    long_enough = sizes >= threshold
    first, count = starts[long_enough], sizes[long_enough] - threshold + 1
    if not len(first):
        return None
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - first, count)
    anchor = (low[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    anchor, lo, hi = anchor[begin], at[begin], at[end]
    doc = np.searchsorted(starts, anchor, "right") - 1
    # Empty texts share a start with their successor; the last of equals holds the bytes.
    base = starts[doc]
    return doc, anchor - base, lo - base, hi - base, h[anchor]


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _batch(core, span, key, place) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [_signed(core), _signed(span), pa.array(key, pa.binary()),
         pa.array(np.asarray(place, np.int64))], _NAMES)


def _packed(anchor, lo, hi):
    return anchor << 16 | (anchor - lo) << 8 | (hi - lo)


def _unpacked(place: int) -> tuple[int, int, int]:
    anchor, first = place >> 16, (place >> 16) - (place >> 8 & 0xFF)
    return anchor, first, first + (place & 0xFF)


def _anchor_rows(threshold: int):
    """Pass 1 over (text): a row per run, digit = anchor gram, span = the run's bytes."""
    def run(batches):
        grams = _Grams()
        for b in chunks(batches, "text", PART_BYTES):
            raw = as_bytes(b.column(0))
            found = runs(raw, grams, threshold)
            if found is None:
                continue
            doc, anchor, lo, hi, core = found
            hashed = xxhash.xxh3_64_intdigest
            views = [memoryview(t) for t in raw]
            span = [hashed(views[d][s:e + threshold], a - s) for d, a, s, e in
                    zip(doc.tolist(), anchor.tolist(), lo.tolist(), hi.tolist())]
            keys = [hashlib.md5(t).digest() for t in raw]
            yield _batch(core, np.array(span, np.uint64), [keys[d] for d in doc.tolist()],
                         _packed(anchor, lo, hi))
    return run


def _class_rows(threshold: int):
    """Pass 2 over (key, packed, open): rows per CLASS offsets of the open runs."""
    def run(batches):
        hashed = xxhash.xxh3_64_intdigest
        for b in chunks(batches, "packed", PART_BYTES):
            core, span, key, place = [], [], [], []
            for k, t, opened in zip(b.column(0).to_pylist(), _texts(b.column(1)),
                                    b.column(2).to_pylist()):
                for p in opened:
                    anchor, lo, hi = _unpacked(p)
                    for c in range((anchor - hi) // CLASS, (anchor - lo) // CLASS + 1):
                        s = max(lo, anchor - c * CLASS - CLASS + 1)
                        e = min(hi, anchor - c * CLASS)
                        shared = anchor - c * CLASS
                        core.append(hashed(t[shared:shared - CLASS + 1 + threshold], c))
                        span.append(hashed(t[s:e + threshold], anchor - s + 1000))
                        key.append(k)
                        place.append(_packed(anchor, s, e))
            yield _batch(np.array(core, np.uint64), np.array(span, np.uint64), key, place)
    return run


def _single_rows(threshold: int):
    """Pass 3 over (key, packed, open): a row per suffix of the open classes."""
    def run(batches):
        hashed, mask = xxhash.xxh3_128_intdigest, (1 << 64) - 1
        for b in chunks(batches, "packed", PART_BYTES):
            core, span, key, place = [], [], [], []
            for k, t, opened in zip(b.column(0).to_pylist(), _texts(b.column(1)),
                                    b.column(2).to_pylist()):
                for p in opened:
                    anchor, lo, hi = _unpacked(p)
                    for s in range(lo, hi + 1):
                        h = hashed(t[s:s + threshold])
                        core.append(h >> 64)
                        span.append(h & mask)
                        key.append(k)
                        place.append(_packed(anchor, s, s))
            yield _batch(np.array(core, np.uint64), np.array(span, np.uint64), key, place)
    return run


def _resolved(rows: DataFrame, last: bool) -> DataFrame:
    """(key, place, state) of the rows that share their digit.

    SETTLED: another row has the same digit and span. OPEN: only the digit is
    shared. BOTH: settled, and the representative its group sends on.
    """
    shared = (rows.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("span").alias("a"),
                                       F.max("span").alias("b"))
              .filter("n > 1").select("core", (F.col("a") != F.col("b")).alias("mixed"))
              .checkpoint(eager=True))
    # Repeated digits grow with the corpus: a shuffle join at every size.
    kept = rows.join(shared, "core").checkpoint(eager=True)
    whole = kept.filter(~F.col("mixed")).select("key", "place", F.lit(SETTLED).alias("state"))
    mixed_rows = kept.filter("mixed").select("core", "span", "key", "place")
    spans = mixed_rows.groupBy("core", "span").agg(F.count(F.lit(1)).alias("n"),
                                                   F.min("key").alias("rep"))
    state = (F.when(F.col("n") == 1, OPEN)
             .when((F.col("key") == F.col("rep")) & F.lit(not last), BOTH).otherwise(SETTLED))
    judged = mixed_rows.join(spans, ["core", "span"]).select("key", "place", state.alias("state"))
    return whole.unionByName(judged)


def _payload(resolved: DataFrame) -> DataFrame:
    """Per text: settled and open places. A text holds them, so a row is bounded by it."""
    return resolved.groupBy("key").agg(
        F.collect_set(F.when(F.col("state") != OPEN, F.col("place"))).alias("new_settled"),
        F.collect_set(F.when(F.col("state") != SETTLED, F.col("place"))).alias("new_open"))


def covered(places, threshold: int) -> list[list[int]]:
    """Merged byte ranges of settled places."""
    out: list[list[int]] = []
    for lo, hi in sorted(_unpacked(p)[1:] for p in places):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + threshold)
        else:
            out.append([lo, hi + threshold])
    return out


def _packed_texts(docs: DataFrame, id_field) -> DataFrame:
    """(id, key, packed) of (id, text): texts travel compressed, with their 128-bit hash."""
    schema = T.StructType([id_field, T.StructField("key", T.BinaryType()),
                           T.StructField("packed", T.BinaryType())])

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for b in chunks(batches, "text", PART_BYTES):
            raw = as_bytes(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([hashlib.md5(t).digest() for t in raw], pa.binary()),
                 pa.array([pack.compress(t) for t in raw], pa.binary())], schema.names)

    return docs.mapInArrow(run, schema)


def _texts(packed: pa.Array) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(z) for z in packed.to_pylist()]


def _step(joined: DataFrame, id_field, threshold: int, with_text: bool, last: bool) -> DataFrame:
    """Results of texts without open places; the others keep their text and places."""
    places = T.ArrayType(T.LongType())
    schema = T.StructType([
        id_field, T.StructField("key", T.BinaryType()), T.StructField("packed", T.BinaryType()),
        T.StructField("settled", places), T.StructField("open", places),
        T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
        T.StructField("kept_text", T.BinaryType())])

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in chunks(batches, "packed", PART_BYTES):
            rows = []
            for z, old, new, opened in zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5))):
                places = (old or []) + (new or [])
                if opened and not last:
                    rows.append((z, places, opened, None, None, None, None, None))
                    continue
                t = unpack.decompress(z)
                ranges = covered(places, threshold)
                kept, at = [], 0
                for s, e in ranges:
                    kept.append(t[at:s])
                    at = e
                kept = b"".join(kept) + t[at:]
                rows.append((None, [], [], len(t), len(t) - len(kept), len(ranges),
                             hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(cols[0], pa.binary())]
                + [pa.array(c, pa.list_(pa.int64())) for c in cols[1:3]]
                + [pa.array(c, pa.int64()) for c in cols[3:6]]
                + [pa.array(cols[6], pa.string()), pa.array(cols[7], pa.binary())], schema.names)

    return joined.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept_text]) of every row.

    Removes each byte covered by a ``threshold``-byte string that also starts
    anywhere else in the table. ``kept_text`` is binary: a cut may split a
    character. ``threshold`` must be 2 * GRAM .. 255 bytes.
    """
    if not 2 * GRAM <= threshold <= 255:
        raise ValueError(f"threshold must be {2 * GRAM}..255, not {threshold}")
    checkpoint_root(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_field = T.StructField("id", rows.schema["id"].dataType)
    no_places = F.array().cast("array<bigint>")
    current = _packed_texts(rows, id_field).withColumn("settled", no_places)
    done = None
    for depth, make in enumerate((_anchor_rows, _class_rows, _single_rows)):
        last = depth == 2
        source = rows.select("text") if depth == 0 else current.select("key", "packed", "open")
        found = _payload(_resolved(source.mapInArrow(make(threshold), _ROW), last))
        joined = (current.join(found, "key", "left")
                  .select("id", "key", "packed", "settled", "new_settled", "new_open"))
        stepped = _step(joined, id_field, threshold, with_text, last)
        if not last:
            stepped = stepped.checkpoint(eager=True)
        finished = stepped.filter(F.col("n_bytes").isNotNull())
        done = finished if done is None else done.unionByName(finished)
        current = stepped.filter(F.col("n_bytes").isNull())
    out = done.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256",
                      "kept_text")
    return out if with_text else out.drop("kept_text")
