"""License scans: fuzzy search for short notices with exact seeds.

A notice of L characters that may differ by k edits is split into k + 1
pieces; whatever the edits, one piece stands unharmed (pigeonhole). All
pieces are searched exactly in the joined texts of a chunk; every hit gives a
candidate window of the notice's length plus k characters on both sides.
Overlapping windows of a notice are merged, and the ``regex`` library's
bounded-error matching verifies them and reports spans and edits.

Texts are compared as words joined by single spaces, so case, punctuation and
line breaks never count as edits. Null text is empty. One result row per input
row; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from basketry.llm.texts import as_bytes, chunks, words


@dataclass(frozen=True)
class Notice:
    label: str
    phrase: str
    edits: int
    base: bool = False


# Base phrases and labels are fixed by the contract; the others are this
# module's own short notices. Every piece keeps five characters or more.
NOTICES = (
    Notice("mit", "mit license", 1, base=True),
    Notice("apache", "apache license", 2, base=True),
    Notice("gpl", "general public license", 3, base=True),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 8),
    Notice("apache", "licensed under the apache license version 2 0", 5),
    Notice("bsd", "redistribution and use in source and binary forms", 5),
    Notice("mpl", "mozilla public license", 2),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("cc-by", "creative commons attribution", 3),
    Notice("cc-by-nc", "licensed under cc by nc", 1),
    Notice("proprietary", "all rights reserved", 2),
)

SPAN = "struct<label:string,first_word:bigint,n_words:bigint,edits:int,limit:int,base:boolean>"


def seeds(pattern: bytes, edits: int) -> list[tuple[int, bytes]]:
    """``edits`` + 1 pieces of ``pattern`` with their offsets."""
    cuts = [len(pattern) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, pattern[a:b]) for a, b in zip(cuts, cuts[1:])]


class _Scanner:
    """Compiled notices. A pattern has a space at both ends: whole words only."""

    def __init__(self, notices):
        self.notices = notices
        self.patterns = [b" " + n.phrase.encode() + b" " for n in notices]
        self.seeds = [seeds(p, n.edits) for p, n in zip(self.patterns, notices)]
        self.regexes = [regex.compile(rb"(?e)(?:%s){e<=%d}" % (regex.escape(p), n.edits))
                        for p, n in zip(self.patterns, notices)]

    def windows(self, joined: bytes, which: int) -> list[list[int]]:
        """Merged candidate windows [start, end) of one notice."""
        k, size = self.notices[which].edits, len(self.patterns[which])
        starts = set()
        for offset, piece in self.seeds[which]:
            at = joined.find(piece)
            while at >= 0:
                starts.add(at - offset)
                at = joined.find(piece, at + 1)
        merged: list[list[int]] = []
        for s in sorted(starts):
            lo, hi = max(s - k, 0), s + size + k
            if merged and lo <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], hi)
            else:
                merged.append([lo, hi])
        return merged

    def matches(self, window: bytes, which: int) -> list[tuple[int, int, int]]:
        """(start, end, edits) in a window: every exact place, then verified fuzzy ones."""
        pattern, found = self.patterns[which], []
        at = window.find(pattern)
        while at >= 0:
            found.append((at, at + len(pattern), 0))
            at = window.find(pattern, at + len(pattern) - 1)  # neighbours share a space
        exact = list(found)
        m = self.regexes[which].search(window)
        while m:
            s, e = m.span()
            if not any(s < b - 1 and a < e - 1 for a, b, _ in exact):
                found.append((s, e, sum(m.fuzzy_counts)))
            m = self.regexes[which].search(window, max(e - 1, s + 1))
        return found

    def scan(self, norms: list[bytes]) -> list[list[tuple]]:
        """Spans of every normalised text (words joined and enclosed by spaces)."""
        starts, at = [], 0
        for n in norms:
            starts.append(at)
            at += len(n) + 1
        joined = b"\n".join(norms)
        out: list[list[tuple]] = [[] for _ in norms]
        for which, notice in enumerate(self.notices):
            for lo, hi in self.windows(joined, which):
                # A window may reach over the end of a text: each text is verified alone.
                doc = max(bisect_right(starts, lo) - 1, 0)
                while doc < len(norms) and starts[doc] < hi:
                    a, b = max(lo - starts[doc], 0), min(hi - starts[doc], len(norms[doc]))
                    for s, e, edits in self.matches(norms[doc][a:b], which) if a < b else ():
                        text = norms[doc][a + s:a + e]
                        first = norms[doc].count(b" ", 0, a + s + 1 if text[:1] == b" " else a + s) - 1
                        out[doc].append((notice.label, first, len(text.split()), edits,
                                         notice.edits, notice.base))
                    doc += 1
        return [sorted(set(x), key=lambda r: (r[1], r[0], r[3], r[2])) for x in out]


def find_notices(docs: DataFrame, notices=NOTICES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_words, spans) of every row; spans count words from 0."""
    rows = docs.select(id_col, text_col)
    kind = rows.schema[id_col].dataType.simpleString()
    fields = [("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()),
              ("edits", pa.int32()), ("limit", pa.int32()), ("base", pa.bool_())]
    span_type = pa.list_(pa.struct(fields))

    def run(batches):
        scanner = _Scanner(notices)
        for b in chunks(batches, text_col):
            split = [words(t) for t in as_bytes(b.column(1))]
            norms = [b" " + b" ".join(w) + b" " for w in split]
            spans = [[dict(zip([f[0] for f in fields], s)) for s in found]
                     for found in scanner.scan(norms)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(w) for w in split], pa.int64()),
                 pa.array(spans, span_type)], [id_col, "n_words", "spans"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_words long, spans array<{SPAN}>")
