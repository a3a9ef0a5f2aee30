"""Token counts: Arrow batches in, lengths out.

Each record batch is taken in chunks of about equal bytes. Their texts are
split at safe boundaries, where the pre-tokenizer starts a new token whatever
stands around: before a space or line feed that follows a letter, digit or
ASCII mark, before a closing mark that follows a letter or digit, and in what is
still above the limit between an ASCII letter and a digit too. Parts encode independently, so equal parts have equal counts: every distinct one is
encoded once, in encoder batches of about equal bytes, and its count is
remembered in the worker within a fixed memory. A text without a safe boundary
stays whole, and all texts do where a special string holds one. Only counts
leave the encoder.

Null text counts as empty: 0 bytes, 0 tokens. One result row per input row, so
repeated rows and repeated or null ids are kept; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.texts import chunks

TOKENIZER = "byte_bpe_50k.json"
ENCODE_BYTES = 1 << 18
# Memory of the counts a worker remembers; a part costs its bytes and about this much more.
KEPT_BYTES = 96 << 20
PART_COST = 180

_WORD = re.compile(r'(?=[ \n,.;:!?)"])(?:(?<=[!-~])(?=[ \n])|(?<=[^\W_]))')
_SAFE = re.compile(r"(?<=[^\W_])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _encoder(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def safe_pieces(text: str, limit: int) -> list[str]:
    """Parts of ``text`` of about ``limit`` characters that encode independently."""
    parts, start = [], 0
    while len(text) - start > limit:
        cut = _SAFE.search(text, start + limit)
        if cut is None:
            break
        parts.append(text[start:cut.start()])
        start = cut.start()
    parts.append(text[start:])
    return parts


class PartCounts(dict):
    """Token counts of text parts, forgotten all at once when they fill their memory."""

    def __init__(self, tok):
        super().__init__()
        self.tok, self.used = tok, 0
        special = [a.content for a in tok.get_added_tokens_decoder().values()]
        self.whole = any(_WORD.search(s) or _SAFE.search(s) for s in special)

    def of(self, texts: list[str], limit: int) -> list[int]:
        """Token count of every text, encoded in batches of about ``limit`` bytes."""
        split = [[t] if self.whole else _WORD.split(t) for t in texts]
        self._encode((p for p in set().union(*split) if p not in self), limit)
        counts = [sum(map(self.__getitem__, parts)) for parts in split]
        if self.used > KEPT_BYTES:
            self.clear()
            self.used = 0
        return counts

    def _encode(self, fresh: Iterable[str], limit: int) -> None:
        batch, owner, held = [], [], 0
        for part in fresh:
            self[part] = 0
            for piece in (safe_pieces(part, limit) if len(part) > limit and not self.whole
                          else (part,)):
                batch.append(piece)
                owner.append(part)
                size = len(piece) if piece.isascii() else len(piece.encode("utf-8", "replace"))
                held += size
                self.used += size + PART_COST
                if held >= limit:
                    self._flush(batch, owner)
                    batch, owner, held = [], [], 0
        self._flush(batch, owner)

    def _flush(self, batch: list[str], owner: list[str]) -> None:
        for part, enc in zip(owner, self.tok.encode_batch_fast(batch, add_special_tokens=False)):
            self[part] += len(enc)


@lru_cache(maxsize=2)
def _part_counts(path: str) -> PartCounts:
    return PartCounts(_encoder(path))


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, limit: int = ENCODE_BYTES) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row. ``tokenizer``: a path on the executors."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        known = _part_counts(tokenizer or tokenizer_path())
        for b in chunks(batches, "t"):
            text = b.column(1)
            size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            counts = known.of([(t or b"").decode("utf-8", "replace")
                               for t in text.cast(pa.binary()).to_pylist()], limit)
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(counts, pa.int64())],
                                             [id_col, "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
