"""Language identification with bit-sliced Bloom filters of n-grams.

Training counts, per language, how often each n-gram stands (grams of four
characters of the lower-cased words with their edges; counted per chunk in the
tasks, then added up by a shuffle on the gram). Every gram enters the filters of
all languages that contain it, however rare it is there. Filters have levels:
the first holds all grams of a language, the next ones those whose rate there is
at least a share (``ratios``) of the gram's best rate, so a gram that is common in one
language and a quotation in another weighs more for the first. No level drops
a gram: in the language of its best rate it is in all of them.

The filters of all languages are one table of bit masks, a bit per level and
language (bit-sliced): the AND of a gram's slots is the set of all languages
that may contain it. The table is filled on Spark (``bit_or`` per slot) and has
BITS_PER_GRAM slots for each gram of the language with most, ``max_slots`` at
most: beyond that filters get fuller and the correction larger, but every gram
is still in. Per-language popcounts over a text's grams, corrected by each
filter's false-positive rate and averaged over the levels, decide; ties go to
the language with the lower name.

Null text, or text without a letter, is ``und`` with score 0. A text with
letters but no known gram gets the language most frequent in training, score
0. Rows without lang or text never train; an empty training set makes every
row ``und``. One result row per input row; repeated rows repeat, extra columns
are ignored. Long texts are read whole, a chunk of the batch each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.texts import as_bytes, chunks, mixed, words
from basketry.session import checkpoint_root

GRAM = 4
RATIOS = (0.0, 0.2)
SLOTS = 3
BITS_PER_GRAM = 12
# 128 MB for up to 32 languages of two levels.
MAX_SLOTS = 1 << 24
UNKNOWN = "und"
_EDGE = np.uint64(0x20)
_POWERS = np.array([0x100000001B3 ** i & (1 << 64) - 1 for i in range(GRAM)], np.uint64)


def gram_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the character grams of the words, one entry per place."""
    points = np.frombuffer((" " + b" ".join(words(text)).decode("utf-8", "replace") + " ")
                           .encode("utf-32-le"), np.uint32).astype(np.uint64)
    # Digits carry no language: they count as edges.
    points = np.where((points >= 0x30) & (points <= 0x39), _EDGE, points)
    if len(points) < GRAM:
        return np.zeros(0, np.uint64)
    n = len(points) - GRAM + 1
    h = np.zeros(n, np.uint64)
    inner = np.zeros(n, np.uint8)
    for i in range(GRAM):
        part = points[i:i + n]
        h += (part + np.uint64(1)) * _POWERS[i]
        inner += part == _EDGE
    # A gram holds at most one word edge, and never spans two words' middles.
    return mixed(h[inner <= 1])


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def gram_counts(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n): places of every gram per language, over all labelled rows."""
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"),
                           F.col(text_col).alias("text")).filter("lang is not null and text is not null")

    def run(batches):
        held: dict[str, list] = {}
        for b in chunks(batches, "text"):
            by_lang: dict[str, list] = {}
            for lang, text in zip(b.column(0).to_pylist(), as_bytes(b.column(1))):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                # A number between two texts: no gram spans both.
                part = np.unique(gram_hashes(b" 0 ".join(texts)), return_counts=True)
                held.setdefault(lang, []).append(part)
                if sum(len(p[0]) for p in held[lang]) > 1 << 20:
                    yield _counts(lang, held.pop(lang))
        for lang, parts in held.items():
            yield _counts(lang, parts)

    counts = rows.mapInArrow(run, "lang string, gram long, n long")
    return counts.groupBy("gram", "lang").agg(F.sum("n").alias("n"))


def _counts(lang: str, parts) -> pa.RecordBatch:
    grams, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n = np.bincount(back, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(grams)), pa.array(grams.view(np.int64)), pa.array(n)],
        ["lang", "gram", "n"])


@dataclass
class Model:
    """Bit masks: row = slot, word = 64 bits, bit = level * languages + language; plus
    what the decision needs."""

    languages: list
    masks: np.ndarray
    false_rate: np.ndarray
    prior: int

    @staticmethod
    def of(languages: list, totals: dict, masks: np.ndarray, levels: int) -> Model:
        """The model of filled masks; false-positive rates come from their fill."""
        fill = popcounts(masks, levels * len(languages)) / len(masks)
        prior = max(range(len(languages)), key=lambda i: (totals[languages[i]], -i))
        return Model(languages, masks, np.minimum(fill ** SLOTS, 0.99), prior)

    def contained(self, grams: np.ndarray) -> np.ndarray:
        """Masks of all languages that (may) contain each gram."""
        out = None
        for s in range(SLOTS):
            m = self.masks[_slot(grams, s, len(self.masks))]
            out = m if out is None else out & m
        return out

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Corrected number of grams per language, averaged over the levels."""
        bits = popcounts(self.contained(grams), len(self.false_rate))
        real = np.maximum((bits - len(grams) * self.false_rate) / (1 - self.false_rate), 0)
        return real.reshape(-1, len(self.languages)).mean(axis=0)

    def decide(self, grams: np.ndarray) -> tuple[int, float, float]:
        """The language, its share of all languages' counts, and of the text's own grams."""
        if not len(grams):
            return self.prior, 0.0, 0.0
        c = self.counts(grams)
        best = int(np.argmax(c))
        if c[best] <= 0:
            return self.prior, 0.0, 0.0
        return best, float(c[best] / c.sum()), float(c[best] / len(grams))


def popcounts(masks: np.ndarray, bits: int) -> np.ndarray:
    """Number of rows with each of the first ``bits`` bits set."""
    flat = masks.astype("<u8", copy=False).view(np.uint8).reshape(len(masks), -1)
    return np.array([np.count_nonzero(flat[:, i // 8] & (1 << i % 8)) for i in range(bits)], float)


def _slot(grams: np.ndarray, which: int, size: int) -> np.ndarray:
    return (mixed(grams + np.uint64(which * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            % np.uint64(size)).astype(np.int64)


def slot_masks(grams: np.ndarray, bits: np.ndarray, size: int, words: int):
    """(place, mask): what the grams' bits add to the table; place = slot * words + word."""
    place = np.concatenate([_slot(grams, s, size) * words + bits // 64 for s in range(SLOTS)])
    mask = np.tile(np.uint64(1) << (bits % 64).astype(np.uint64), SLOTS)
    order = np.argsort(place, kind="stable")
    place, mask = place[order], mask[order]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return place[first], np.bitwise_or.reduceat(mask, first) if len(first) else mask


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
        ratios: tuple = RATIOS, max_slots: int = MAX_SLOTS) -> Model | None:
    """The filters of all languages; None without labelled text.

    Only the filled table reaches the driver, ``max_slots`` slots at most
    however large the corpus.
    """
    checkpoint_root(labelled.sparkSession)
    counts = gram_counts(labelled, text_col, lang_col).checkpoint(eager=True)
    found = counts.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("grams")).collect()
    if not found:
        return None
    totals = {r["lang"]: r["n"] for r in sorted(found, key=lambda r: r["lang"])}
    languages = list(totals)
    size = min(max(64, BITS_PER_GRAM * max(r["grams"] for r in found)), max_slots)
    words = (len(ratios) * len(languages) + 63) // 64
    entries = gram_bits(counts, totals, ratios)

    def run(batches):
        for b in batches:
            place, mask = slot_masks(b.column(0).to_numpy().view(np.uint64),
                                     b.column(1).to_numpy().astype(np.int64), size, words)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(mask.view(np.int64))],
                                             ["place", "mask"])

    filled = (entries.mapInArrow(run, "place long, mask long")
              .groupBy("place").agg(F.expr("bit_or(mask)").alias("mask")).toArrow())
    masks = np.zeros(size * words, np.uint64)
    masks[filled.column("place").to_numpy()] = filled.column("mask").to_numpy().view(np.uint64)
    return Model.of(languages, totals, masks.reshape(size, words), len(ratios))


def gram_bits(counts: DataFrame, totals: dict, ratios: tuple) -> DataFrame:
    """(gram, bit) of every level and language that a gram is in."""
    number = {lang: i for i, lang in enumerate(totals)}
    per_lang = {name: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])
                for name, m in (("total", totals), ("number", number))}
    rates = counts.select("gram", F.element_at(per_lang["number"], F.col("lang")).alias("number"),
                          (F.col("n") / F.element_at(per_lang["total"], F.col("lang"))).alias("rate"))
    best = rates.groupBy("gram").agg(F.max("rate").alias("best"),
                                     F.collect_list(F.struct("number", "rate")).alias("all"))

    def level(j: int, ratio: float):
        near = F.filter("all", lambda x: x["rate"] >= F.col("best") * ratio)
        return F.transform(near, lambda x: x["number"] + j * len(totals))

    levels = [level(j, ratio) for j, ratio in enumerate(ratios)]
    return best.select("gram", F.explode(F.concat(*levels)).alias("bit"))


def judge(texts: list[bytes], model: Model | None) -> list[tuple[str, float]]:
    """(language, score) of every text; None counts as null."""
    return [(lang, score) for lang, score, _ in _judged(texts, model)]


def _judged(texts: list[bytes], model: Model | None) -> list[tuple[str, float, float]]:
    out = []
    for t in texts:
        if t is None or model is None or not has_letter(t.decode("utf-8", "replace")):
            out.append((UNKNOWN, 0.0, 0.0))
            continue
        which, score, known = model.decide(gram_hashes(t))
        out.append((model.languages[which], round(score, 6), round(known, 6)))
    return out


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row. The model is ``max_slots`` masks at most, a
    proven bound."""
    rows = docs.select(id_col, text_col)
    kind = rows.schema[id_col].dataType.simpleString()
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in chunks(batches, text_col):
            found = judge(b.column(1).cast(pa.binary()).to_pylist(), held.value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], [id_col, "lang_pred", "score"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """True for rows kept out of training: crc32(id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def keep_identified(docs: DataFrame, model: Model | None, min_score: float = 0.0,
                    text_col: str = "text") -> DataFrame:
    """Rows with an identified language, all columns as they were. ``min_score`` of a
    text's own grams must be the language's: unlike ``score``, a measure that does not
    fall with the number of languages that resemble each other."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in chunks(batches, text_col):
            found = _judged(b.column(at).cast(pa.binary()).to_pylist(), held.value)
            yield b.filter(pa.array([l != UNKNOWN and k >= min_score for l, _, k in found]))

    return docs.mapInArrow(run, docs.schema)
