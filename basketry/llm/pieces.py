"""SentencePiece segmentations sampled by forward filtering, backward sampling.

A text (with the usual leading space) is cut where a space follows a
non-space; no piece of the vocabulary crosses such a place, so the lattice of
a text is the chain of its chunks' lattices and each chunk is sampled alone.
The forward pass sums the weights of all segmentations that end at each
character of a chunk; it runs once per distinct chunk of a record-batch part,
for all short chunks together, and a worker keeps the lattices of repeated chunks
within a fixed memory. The backward pass draws the last piece, then the one before
it, and so on: all chunk occurrences of the part draw together, one vectorised
step per piece. Draws are hashes of (seed, row key, chunk, step), so
a row gets the same segmentation wherever and however often it is computed; the
sums they are held against start anew at each node, whatever else is in the part.

The model's scores are merge ranks; a piece of rank r weighs (r + 1) ** -alpha.
Characters without a piece, and U+2581 itself, become byte pieces, so decoding
gives every text back exactly.

Null text has null pieces and decodes to null; empty text has none and decodes
to empty. Rows are independent: repeated rows and keys are kept as they are.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.texts import chunks, mixed

MODEL = "piece_bpe_32k.model"
PART_BYTES = 1 << 18     # a part's lattices take some 200 bytes a byte of text
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
KEPT_NODES = 1 << 19     # nodes of the lattices a worker keeps, some 30 MB
SHORT = 24               # characters of a chunk up to which chunks are filtered together
_CHUNK = re.compile(r" *[^ ]+| +")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PRIME = 0x100000001B3


def _points(text: str) -> np.ndarray:
    """Code points plus one, so that no character is a zero."""
    raw = text.encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).astype(np.uint64) + np.uint64(1)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Lattices:
    """Pieces of a model, and the lattices of chunks over them.

    Chunks up to ``SHORT`` characters are filtered together, position by
    position; longer ones one by one. Pieces are looked up by a 64-bit hash of
    their characters.
    """

    def __init__(self, path: str, alpha: float):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of: list[bytes] = []
        self.weight: dict[str, tuple[float, int]] = {}
        self.byte_id = np.zeros(256, np.int32)
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes_of.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                shown = piece.replace("▁", " ")
                self.bytes_of.append(shown.encode())
                self.weight[shown] = ((1.0 - sp.get_score(i)) ** -alpha, i)
        self.longest = max(map(len, self.weight))
        self.fallback = float(len(self.bytes_of)) ** -alpha
        self.power = np.array([pow(_PRIME, i, 1 << 64) for i in range(self.longest)], np.uint64)
        hashes = np.array([self._hash(_points(p)) for p in self.weight], np.uint64)
        # Pieces by hash slot: a lookup reads a slot's bounds and rarely anything else.
        order = np.argsort(_slot(hashes), kind="stable")
        self.piece_hash = hashes[order]
        self.slot_start = np.searchsorted(_slot(self.piece_hash), np.arange(SLOTS + 1)).astype(np.int32)
        self.piece_weight = np.array([w for w, _ in self.weight.values()])[order]
        self.piece_id = np.array([i for _, i in self.weight.values()], np.int64)[order]
        size = np.array(list(map(len, self.bytes_of)))
        self.pool = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.pool_size, self.pool_start = size, np.cumsum(size) - size
        self.known: dict[str, int] = {}
        self.kept = self.filtered([])

    def _hash(self, points: np.ndarray) -> np.uint64:
        return (points * self.power[:len(points)][::-1]).sum(dtype=np.uint64)

    def _lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, pieces) of the hashes that are pieces."""
        slot = _slot(h)
        start, end = self.slot_start[slot], self.slot_start[slot + 1]
        rows = np.flatnonzero(start < end)
        at, end, want = start[rows], end[rows], h[rows]
        out_rows, out_pieces = [], []
        while len(rows):
            hit = self.piece_hash[at] == want
            out_rows.append(rows[hit])
            out_pieces.append(at[hit])
            more = ~hit & (at + 1 < end)
            rows, at, end, want = rows[more], at[more] + 1, end[more], want[more]
        if len(out_rows) == 1:
            return out_rows[0], out_pieces[0]
        return (np.concatenate(out_rows), np.concatenate(out_pieces)) if out_rows else (rows, at)

    def filtered(self, distinct: list[str]):
        """(last node of each chunk, node -> first edge, edge arrays cum, prev, piece).

        Nodes stand for the places after a chunk's characters; ``prev`` is -1
        at its start. ``cum`` adds up the probabilities of a node's edges.
        """
        length = np.fromiter(map(len, distinct), np.int64, len(distinct))
        last = np.cumsum(length)
        offset = last - length
        first = np.zeros(int(length.sum()) + 1, np.int64)
        parts = [(np.zeros(0, np.int32),) * 2 + (np.zeros(0),) + (np.zeros(0, np.int32),) * 2]
        short = np.flatnonzero(length <= SHORT)
        short = short[np.argsort(-length[short], kind="stable")]
        self._short([distinct[i] for i in short], length[short], offset[short], first, parts)
        for i in np.flatnonzero(length > SHORT):
            parts.append(self._long(distinct[i], int(offset[i]), first))
        np.cumsum(first, out=first)
        node, rank, share, before, which = (np.concatenate(x) for x in zip(*parts))
        at = first[node] + rank
        cum, prev, piece = np.empty(len(at)), np.empty(len(at), np.int32), np.empty(len(at), np.int32)
        cum[at], prev[at], piece[at] = share, before, which
        return last - 1, first, cum, prev, piece

    def lattices(self, fresh: list[str], repeated: int):
        """The kept lattices and, numbered on from them, those of ``fresh``, whose first
        ``repeated`` chunks are kept from now on as far as there is room."""
        last, first, cum, prev, piece = self.kept
        new = self.filtered(fresh)
        nodes = len(first) - 1
        out = (np.concatenate([last, new[0] + nodes]),
               np.concatenate([first[:-1], new[1] + len(cum)]), np.concatenate([cum, new[2]]),
               np.concatenate([prev, np.where(new[3] < 0, np.int32(-1), new[3] + np.int32(nodes))]),
               np.concatenate([piece, new[4]]))
        room = int(np.searchsorted(new[0], KEPT_NODES - nodes))
        if keep := min(repeated, room):
            self.known.update(zip(fresh[:keep], range(len(last), len(last) + keep)))
            ends = len(last) + keep
            stop = int(out[0][ends - 1]) + 1
            edges = int(out[1][stop])
            self.kept = (out[0][:ends].copy(), out[1][:stop + 1].copy(),
                         *(x[:edges].copy() for x in out[2:]))
        return out

    def _short(self, texts, length, offset, degrees, parts) -> None:
        """Forward filter of chunks sorted by falling length, all at once."""
        if not texts:
            return
        wide = int(length[0])
        points = np.zeros((len(texts), wide), np.uint64)
        inside = np.arange(wide) < length[:, None]
        points[inside] = _points("".join(texts))
        alpha = np.ones((len(texts), wide + 1))
        for e in range(1, wide + 1):
            k = int(np.searchsorted(-length, -e, side="right"))
            h, total, found = np.zeros(k, np.uint64), np.zeros(k), []
            degree = np.zeros(k, np.int64)
            for d in range(1, min(self.longest, e) + 1):
                b = e - d
                h += points[:k, b] * self.power[d - 1]
                who, at = self._lookup(h)
                if not len(who) and d > 1:
                    continue
                w = alpha[who, b] * self.piece_weight[at]
                total[who] += w
                found.append((who, degree[who], b, w, self.piece_id[at]))
                degree[who] += 1
                if d == 1:  # a character without a piece of its own
                    bare = np.ones(k, bool)
                    bare[who] = False
                    who = np.flatnonzero(bare)
                    w = alpha[who, b] * self.fallback
                    total[who] += w
                    found.append((who, degree[who], b, w, -points[who, b].astype(np.int64)))
                    degree[who] += 1
            alpha[:k, e] = total
            degrees[offset[:k] + e] = degree
            cum = np.zeros(k)
            for who, rank, b, w, piece in found:
                cum[who] += w / total[who]
                start = offset[who]
                before = start + b - 1 if b else np.full(len(who), -1)
                parts.append(((start + e - 1).astype(np.int32), rank.astype(np.int32), cum[who],
                              before.astype(np.int32), piece.astype(np.int32)))

    def _long(self, chunk: str, offset: int, degrees: np.ndarray):
        """Forward filter of one long chunk."""
        get = self.weight.get
        alpha, node, rank, prev, cum, piece = [1.0], [], [], [], [], []
        for e in range(1, len(chunk) + 1):
            edges, total = [], 0.0
            for b in range(max(0, e - self.longest), e):
                hit = get(chunk[b:e])
                if hit is None and b == e - 1:
                    hit = (self.fallback, -1 - ord(chunk[b]))
                if hit is not None:
                    edges.append((b, alpha[b] * hit[0], hit[1]))
                    total += edges[-1][1]
            degrees[offset + e] = len(edges)
            share = 0.0
            for r, (b, w, i) in enumerate(edges):
                node.append(offset + e - 1)
                rank.append(r)
                prev.append(offset + b - 1 if b else -1)
                share += w / total
                cum.append(share)
                piece.append(i)
            alpha.append(total)
            if total < 1e-200:  # only ratios of the last ``longest`` sums are used again
                for i in range(max(0, e - self.longest), e + 1):
                    alpha[i] *= 1e200
        return tuple(map(np.array, (node, rank, cum, prev, piece)))

    def sample(self, texts: list[str], keys: list[bytes], seed: int) -> list[np.ndarray]:
        """Sampled piece ids of every text."""
        number = _Numbers(self.known)
        which, counts = [], []
        for t in texts:
            part = _CHUNK.findall(" " + t) if t else []
            which.extend(map(number.__getitem__, part))
            counts.append(len(part))
        if not which:
            return [np.zeros(0, np.int32) for _ in texts]
        which, old = np.array(which), len(self.known)
        seen = np.bincount(which, minlength=len(number))[old:]
        order = np.argsort(-seen, kind="stable")  # the most frequent chunks are kept first
        place = np.empty_like(order)
        place[order] = np.arange(old, len(number))
        new = which >= old
        which[new] = place[which[new] - old]
        last, first, cum, prev, piece = self.lattices([number.fresh[i] for i in order],
                                                      int((seen > 1).sum()))
        width, spelled = self._spelling(piece)
        counts = np.array(counts)
        row_seed = np.array([xxhash.xxh3_64_intdigest(k, seed=seed) for k in keys], np.uint64)
        index = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        draw = mixed(np.repeat(row_seed, counts) + (index.astype(np.uint64) + np.uint64(1)) * _STEP)
        at = last[which]
        active = np.arange(len(at))
        total = np.zeros(len(at), np.int64)
        steps = []
        turn = 0
        while len(active):
            turn += 1
            u = (mixed(draw[active] + np.uint64(turn * int(_STEP) & (1 << 64) - 1))
                 >> np.uint64(11)).astype(float) * 2.0 ** -53
            node = at[active]
            edge, end = first[node], first[node + 1] - 1
            on = np.flatnonzero((u >= cum[edge]) & (edge < end))
            while len(on):
                edge[on] += 1
                on = on[(u[on] >= cum[edge[on]]) & (edge[on] < end[on])]
            steps.append((active, edge))
            total[active] += width[edge]
            at[active] = prev[edge]
            active = active[prev[edge] >= 0]
        cursor = np.cumsum(total)
        out = np.zeros(int(cursor[-1]), np.int32)
        for who, edge in steps:
            cursor[who] -= width[edge]
            out[cursor[who]] = piece[edge]
            bare = np.flatnonzero(piece[edge] < 0)
            for j in range(4):
                bare = bare[width[edge[bare]] > j]
                out[cursor[who[bare]] + j] = spelled(piece[edge[bare]], j)
        ends = np.concatenate([[0], np.cumsum(total)])[np.concatenate([[0], np.cumsum(counts)])]
        return [out[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def _spelling(self, piece: np.ndarray):
        """Ids each edge stands for, and byte piece ``j`` of a character without a piece."""
        bare = np.unique(piece[piece < 0])
        raw = [chr(-1 - int(p)).encode("utf-8", "surrogateescape") for p in bare]
        table = np.zeros((len(raw) + 1, 4), np.int32)
        for i, r in enumerate(raw):
            table[i, :len(r)] = self.byte_id[list(r)]
        size = np.array([len(r) for r in raw] + [1])
        width = np.ones(len(piece), np.int64)
        negative = piece < 0
        width[negative] = size[np.searchsorted(bare, piece[negative])]
        return width, lambda p, j: table[np.searchsorted(bare, p), j]

    def decode(self, ids, counts=None) -> list[bytes]:
        """UTF-8 texts of runs of ``counts`` ids: the pieces' bytes without the leading space."""
        ids = np.asarray(ids, np.int64)
        counts = np.array([len(ids)]) if counts is None else np.asarray(counts)
        size = self.pool_size[ids]
        ends = np.cumsum(size)
        place = np.arange(int(ends[-1]) if len(ends) else 0)
        place += np.repeat(self.pool_start[ids] - (ends - size), size)
        raw = self.pool[place].tobytes()
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [raw[a + 1:b] if b > a else b"" for a, b in zip(cuts, cuts[1:])]


class _Numbers(dict):
    """Chunks numbered as they come; known ones keep the number they have."""

    def __init__(self, known: dict):
        super().__init__(known)
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self)
        self.fresh.append(chunk)
        return n


def _slot(h: np.ndarray) -> np.ndarray:
    return (h * _STEP >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


@lru_cache(maxsize=2)
def _lattices(path: str, alpha: float) -> Lattices:
    return Lattices(path, alpha)


def _sampled(docs: DataFrame, id_col: str, text_col: str, seed: int, alpha: float,
             model: str | None, key_col: str | None, and_decode: bool) -> DataFrame:
    rows = docs.select(id_col, text_col)
    schema = T.StructType([rows.schema[id_col], rows.schema[text_col],
                           T.StructField("piece_ids", T.ArrayType(T.IntegerType())),
                           T.StructField("ids_sha256", T.StringType())]
                          + [T.StructField("decoded", T.StringType())] * and_decode)
    keys = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"),
                       F.to_json(F.struct(F.col(key_col or id_col).alias("k"))).alias("key"))

    def run(batches):
        lattices = _lattices(model or model_path(), alpha)
        for b in chunks(batches, "t", PART_BYTES):
            raw = b.column(1).cast(pa.binary()).to_pylist()
            ids = lattices.sample([(r or b"").decode("utf-8", "surrogateescape") for r in raw],
                                  b.column(2).cast(pa.binary()).to_pylist(), seed)
            counts = np.array([len(x) for x in ids])
            null = pc.is_null(b.column(1))
            flat = np.concatenate(ids)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
                pa.array(flat, pa.int32()), mask=null)
            columns = [b.column(0), b.column(1), lists,
                       pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids])]
            if and_decode:
                columns.append(_decoded(lattices, flat, counts, null))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return keys.mapInArrow(run, schema)


def _decoded(lattices: Lattices, flat, counts, null: pa.Array) -> pa.Array:
    texts = lattices.decode(flat, counts)
    return pa.array(texts, pa.binary(), mask=null.to_numpy(zero_copy_only=False)).cast(
        pa.string(), safe=False)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
           alpha: float = 1.0, model: str | None = None, key_col: str | None = None) -> DataFrame:
    """(id, text, piece_ids, ids_sha256) of every row.

    ``key_col`` is the row key (``id_col`` where not given); ``model``: path of
    the model on the executors.
    """
    return _sampled(docs, id_col, text_col, seed, alpha, model, key_col, False)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
               alpha: float = 1.0, model: str | None = None, key_col: str | None = None) -> DataFrame:
    """``encode`` with the text the pieces decode to in ``decoded``, in one pass."""
    return _sampled(docs, id_col, text_col, seed, alpha, model, key_col, True)


def decode(encoded: DataFrame, ids_col: str = "piece_ids", out_col: str = "decoded",
           model: str | None = None) -> DataFrame:
    """``encoded`` with the text of ``ids_col`` in ``out_col`` (replaced if it exists)."""
    at = encoded.columns.index(ids_col)
    kept = [c for c in encoded.columns if c != out_col]
    schema = T.StructType([encoded.schema[c] for c in kept]
                          + [T.StructField(out_col, T.StringType())])

    def run(batches):
        lattices = _lattices(model or model_path(), 1.0)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                b = batch.slice(start, 256)
                counts = pc.fill_null(pc.list_value_length(b.column(at)), 0).to_numpy(zero_copy_only=False)
                text = _decoded(lattices, b.column(at).flatten().to_numpy(zero_copy_only=False),
                                counts, pc.is_null(b.column(at)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index(c)) for c in kept] + [text], schema.names)

    return encoded.mapInArrow(run, schema)


def tokenise(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text",
             seed: int = 42) -> DataFrame:
    """``docs`` with ``piece_ids``, and the text as those pieces decode to."""
    others = [c for c in docs.columns if c not in (text_col, "piece_ids")]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
                         F.col(f"`{text_col}`").alias("text"), F.col(f"`{key_col}`").alias("key"))
    out = round_trip(packed, "row", "text", seed, key_col="key")
    kept = [c for c in docs.columns if c != "piece_ids"]
    return out.select(*[F.col("decoded").alias(c) if c == text_col
                        else F.col(f"row.`{c}`").alias(c) for c in kept], "piece_ids")
