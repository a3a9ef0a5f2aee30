"""Whitening of embeddings by incremental eigendecomposition.

Every partition keeps a spectrum (count, sums, eigenvalues and eigenvectors of
its scatter) and takes its vectors one by one: a vector ``x`` changes the
scatter by the centred rank-one term ``n / (n + 1) (x - mean)(x - mean)'``. A
rank-one update is solved exactly: components of the update that vanish and
groups of equal eigenvalues are deflated (one reflection a group), the rest are
the roots of the secular equation, found inside the gaps between the old
eigenvalues; the new vectors follow from Loewner's formula, which keeps them
orthogonal whatever the error of the roots. Two spectra are combined by
successive rank-one updates, one for each eigenpair of the second and one for the
distance of the means; partitions meet in groups of eight, level by level. A last
pass over all rows projects the exact covariance on the combined basis
(Rayleigh-Ritz) and rotates the basis by the eigenvectors of that small matrix,
which brings the components to double precision. Only matrices of the size of
the dimension reach the driver.

Entries are quantised, ``x = floor(64 * c) + 1000000``; saturated at 2^52, which
no real embedding comes near. Rows are dropped where the vector is null, or holds
null or non-finite entries, or has another length than most vectors have (ties:
the longest), since one covariance needs one dimension; empty vectors are dropped
too. Copies count each time they occur; null ids and repeated rows keep their
rows. Equal eigenvalues: any orthonormal basis of their space, the same for all
rows. Components without variance (below 1e-12 of the trace), and all of them
where there is one vector only, have ``whitened`` null and do not count for
``identity_error``. An empty table gives an empty result. ``deviation`` is null
where it exceeds a long. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import checkpoint_root

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
FAN_IN = 8
_EPS = np.finfo(float).eps
_SATURATED = 2.0 ** 52
_RANK = 1e-12


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pole, offset) of the roots of ``1 + sum(z2 / (d - x)) = 0``; ``d`` ascends.

    Root i lies between ``d[i]`` and ``d[i + 1]`` (the last one below
    ``d[-1] + sum(z2)``) and is given as an offset from its nearest pole.
    """
    k = len(d)
    gap = np.append(np.diff(d), z2.sum())
    middle = d + gap / 2
    value = 1 + (z2 / (d - middle[:, None])).sum(axis=1)
    left = value >= 0
    left[-1] = True
    pole = np.where(left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    low = np.where(left, 0.0, -gap / 2)
    high = np.where(left, gap / 2, 0.0)
    low[-1], high[-1] = 0.0, gap[-1]
    shifted = d[None, :] - d[pole][:, None]
    behind = np.tri(k)
    to_left = shifted[np.arange(k), np.arange(k)]
    to_right = np.append(shifted[np.arange(k - 1), np.arange(1, k)], np.inf)
    x, done = (low + high) / 2, np.zeros(k, bool)
    for _ in range(60):
        away = shifted - x[:, None]
        away[away == 0] = _EPS * gap.min()
        terms = z2 / away
        value = 1 + terms.sum(axis=1)
        done |= np.abs(value) <= k * _EPS * (1 + np.abs(terms).sum(axis=1))
        done |= high - low <= 4 * _EPS * np.abs(x)
        if done.all():
            break
        # The sum rises with x between two poles.
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        new = _two_poles(value, terms / away, behind, to_left - x, to_right - x, x)
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        x = np.where(done, x, new)
    return pole, x


def _two_poles(value, slopes, behind, left, right, x) -> np.ndarray:
    """Root of ``c + a / (left - s) + b / (right - s)`` with the sum's value and slopes at x."""
    total = slopes.sum(axis=1)
    psi = (slopes * behind).sum(axis=1)
    phi = total - psi
    with np.errstate(all="ignore"):
        end = np.isinf(right)
        right = np.where(end, 1.0, right)
        a, b = psi * left * left, np.where(end, 0.0, phi * right * right)
        c = value - psi * left - np.where(end, 0.0, phi * right)
        middle = (c * (left + right) + a + b) / 2
        last = c * left * right + a * right + b * left
        root = np.sqrt(np.maximum(middle * middle - c * last, 0))
        step = np.where(middle > 0, last / (middle + root), (middle - root) / c)
        step = np.where(end, left + a / c, step)
    return x + step


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray, weight: float = 1.0):
    """Eigenpairs of ``V diag(values) V' + weight * u u'``; values ascend."""
    z = vectors.T @ u * np.sqrt(weight)
    size = float(z @ z)
    if not size > 0:
        return values, vectors
    tiny = 8 * _EPS * max(abs(values[-1]), abs(values[0]), size)
    close = np.flatnonzero(np.diff(values) <= tiny)
    if len(close):  # equal eigenvalues: one vector of the group takes the whole update
        vectors, z = vectors.copy(), z.copy()
        for run in np.split(close, np.flatnonzero(np.diff(close) > 1) + 1):
            group = slice(run[0], run[-1] + 2)
            part = z[group]
            length = np.copysign(np.linalg.norm(part), part[0])
            if length:
                mirror = part.copy()
                mirror[0] += length
                mirror /= np.linalg.norm(mirror)
                vectors[:, group] -= 2 * np.outer(vectors[:, group] @ mirror, mirror)
                z[group] = 0
                z[run[0]] = -length
    live = np.flatnonzero(z * z > tiny * _EPS)
    live = live[np.abs(z[live]) * np.sqrt(size) > tiny]
    if not len(live):
        return values, vectors
    d, z2 = values[live], z[live] ** 2
    pole, offset = secular_roots(d, z2)
    base = d[pole]
    away = (d[:, None] - base[None, :]) - offset[None, :]      # d_i - root_j
    away[away == 0] = -tiny * _EPS
    # Loewner: the update that has exactly these roots.
    k = len(d)
    gaps = d[:, None] - d[None, :]
    np.fill_diagonal(gaps, 1.0)
    ratio = -away / np.where(np.eye(k, dtype=bool), 1.0, -gaps)
    exact = np.abs(np.prod(ratio, axis=1))
    w = np.copysign(np.sqrt(exact), z[live])[:, None] / away
    w /= np.linalg.norm(w, axis=0)
    values, vectors = values.copy(), vectors.copy()
    vectors[:, live] = vectors[:, live] @ w
    values[live] = base + offset
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, exact sums, and eigenpairs of the scatter of vectors seen so far."""

    def __init__(self, d: int):
        self.n, self.sums = 0, np.zeros(d, np.int64)
        self.mean, self.values, self.vectors = np.zeros(d), np.zeros(d), np.eye(d)

    def add(self, x: np.ndarray, times: int = 1) -> None:
        """``times`` copies of one vector (their own scatter is none)."""
        n = self.n + times
        u = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, u,
                                                 self.n * times / n)
        self.mean = self.mean + u * (times / n)
        self.n, self.sums = n, self.sums + (x.astype(np.int64) + OFFSET) * times

    def combine(self, other: Spectrum) -> None:
        if not self.n or not other.n:
            if other.n:
                self.__dict__.update(other.__dict__)
            return
        n = self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
        u = other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, u, self.n * other.n / n)
        self.mean = self.mean + u * (other.n / n)
        self.n, self.sums = n, self.sums + other.sums

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "sums": self.sums.tolist(), "mean": self.mean.tolist(),
                "values": self.values.tolist(), "vectors": self.vectors.ravel().tolist()}

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        out = cls(len(row["sums"]))
        out.n, out.sums = row["n"], np.array(row["sums"], np.int64)
        out.mean, out.values = np.array(row["mean"]), np.array(row["values"])
        out.vectors = np.array(row["vectors"]).reshape(len(out.sums), len(out.sums))
        return out


_SPECTRUM = ("part long, n long, sums array<long>, mean array<double>, values array<double>, "
             "vectors array<double>")


def _quantised(column: pa.ListArray, d: int) -> np.ndarray:
    """(rows, d) doubles ``floor(64 c)``, whole numbers; the offset is left out."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.clip(np.floor(SCALE * flat), -_SATURATED, _SATURATED)


def usable(embeddings: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, v) rows that take part, and their dimension (0 where there is none)."""
    finite = F.forall(F.col("v").cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c)
                      & (F.abs(c) < F.lit(float("inf"))))
    rows = (embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
            .filter(F.col("v").isNotNull()).filter((F.size("v") > 0) & finite))
    most = (rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("d").desc()).limit(1).collect())
    d = most[0]["d"] if most else 0
    return rows.filter(F.size("v") == d), d


def fit_spectrum(rows: DataFrame, d: int) -> Spectrum:
    """The combined spectrum of all rows, by partitions and then in groups of eight."""
    def partial(batches):
        own, part = Spectrum(d), None
        for b in batches:
            x = _quantised(b.column(1), d)
            if not len(x):
                continue
            part = b.column(0)[0].as_py()
            # Copies of a batch are one weighted update.
            kinds, first, times = np.unique(x, axis=0, return_index=True, return_counts=True)
            for i in np.argsort(first):
                own.add(kinds[i], int(times[i]))
        if own.n:
            yield pa.RecordBatch.from_pylist([own.row(part)], schema=arrow)

    def joined(key, table):
        total = None
        for row in sorted(table.to_pylist(), key=lambda r: r["part"]):
            one = Spectrum.of(row)
            if total is None:
                total = one
            else:
                total.combine(one)
        return pa.Table.from_pylist([total.row(key[0].as_py())], schema=arrow)

    arrow = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())),
                       ("mean", pa.list_(pa.float64())), ("values", pa.list_(pa.float64())),
                       ("vectors", pa.list_(pa.float64()))])
    checkpoint_root(rows.sparkSession)
    spectra = (rows.select(F.spark_partition_id().cast("long").alias("part"), "v")
               .mapInArrow(partial, _SPECTRUM).checkpoint(eager=True))
    last = spectra.agg(F.max("part")).first()[0]
    while last > 0:
        spectra = (spectra.groupBy(F.floor(F.col("part") / FAN_IN).cast("long").alias("to"))
                   .applyInArrow(joined, _SPECTRUM).checkpoint(eager=True))
        last //= FAN_IN
    return Spectrum.of(spectra.first().asDict())


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S / n`` of quantised vectors without their offset."""
    whole, rest = np.divmod(sums - n * OFFSET, n)
    return (x - whole) - rest / n


def _products(rows: DataFrame, d: int, n: int, sums: np.ndarray, basis: np.ndarray):
    """(sum of p p', sum of p) over all rows, p the centred vector times ``basis``."""
    k = basis.shape[1]

    def run(batches):
        outer, plain = np.zeros((k, k)), np.zeros(k)
        for b in batches:
            p = _centred(_quantised(b.column(0), d), n, sums) @ basis
            outer += p.T @ p
            plain += p.sum(axis=0)
        cells = np.concatenate([outer.ravel(), plain])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)],
                                         ["cell", "part"])

    cells = (rows.select("v").mapInArrow(run, "cell long, part double")
             .groupBy("cell").agg(F.sum("part").alias("total")).collect())
    flat = np.zeros(k * k + k)
    for c in cells:  # as many as the matrix has cells
        flat[c["cell"]] = c["total"]
    return flat[:k * k].reshape(k, k), flat[k * k:]


class Whitening:
    """Eigenvalues (falling), components as columns, count and sums of a fit list."""

    def __init__(self, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums, self.values, self.vectors = n, sums, values, vectors
        self.trace = float(values.sum())

    @classmethod
    def fit(cls, rows: DataFrame, d: int) -> Whitening:
        """Combined spectrum, then one exact Rayleigh-Ritz pass over ``rows``."""
        rough = fit_spectrum(rows, d)
        basis, _ = np.linalg.qr(rough.vectors[:, ::-1])
        outer, _ = _products(rows, d, rough.n, rough.sums, basis)
        values, turn = np.linalg.eigh(outer / rough.n)
        order = np.argsort(-values, kind="stable")
        return cls(rough.n, rough.sums, np.maximum(values[order], 0), basis @ turn[:, order])

    def scale(self, k: int) -> np.ndarray:
        """1 / sqrt(eigenvalue); NaN for components without variance."""
        live = self.values[:k] > _RANK * max(self.trace, 0)
        with np.errstate(divide="ignore"):
            return np.where(live, 1 / np.sqrt(np.where(live, self.values[:k], 1)), np.nan)

    def identity_error(self, rows: DataFrame, k: int) -> float | None:
        """Largest entry of the whitened rows' covariance minus the identity."""
        scale = self.scale(k)
        live = np.flatnonzero(~np.isnan(scale))
        if not len(live):
            return None
        basis = self.vectors[:, live] * scale[live]
        outer, plain = _products(rows, len(self.sums), self.n, self.sums, basis)
        mean = plain / self.n
        return float(np.abs(outer / self.n - np.outer(mean, mean) - np.eye(len(live))).max())


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list:
    """Exact ``sum((n * x - S)^2)``, None beyond a long."""
    rest = sums - n * OFFSET
    bound = n * float(np.abs(x).max(initial=0)) + float(np.abs(rest).max())
    if x.shape[1] * bound * bound < 2.0 ** 62:
        y = x.astype(np.int64) * n - rest
        return (y * y).sum(axis=1).tolist()
    out = []
    for row in x.astype(np.int64).tolist():
        total = sum((n * a - int(s)) ** 2 for a, s in zip(row, rest))
        out.append(total if total < 1 << 63 else None)
    return out


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) rows."""
    rows, d = usable(embeddings, id_col, vector_col)
    schema = T.StructType([
        T.StructField(id_col, embeddings.schema[id_col].dataType),
        T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    if not d:
        return embeddings.sparkSession.createDataFrame([], schema)
    model, k = Whitening.fit(rows, d), min(components, d)
    error = model.identity_error(rows, k)
    n, sums, scale = model.n, model.sums, model.scale(k)
    basis = model.vectors[:, :k] * np.where(np.isnan(scale), 0, scale)
    explained = model.values[:k] / model.trace if model.trace > 0 else np.full(k, np.nan)

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                b = whole.slice(start, 2048)
                x, m = _quantised(b.column(1), d), b.num_rows
                p = _centred(x, n, sums) @ basis
                p[:, np.isnan(scale)] = np.nan
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(each)),
                    pa.array(p.ravel(), from_pandas=True),
                    pa.array(np.tile(explained, m), from_pandas=True),
                    pa.array([error] * (m * k), pa.float64())], schema.names)

    return rows.mapInArrow(run, schema)
