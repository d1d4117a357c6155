"""Whitening of embeddings by an incremental eigendecomposition.

Each task keeps a mean and the eigenvalues and eigenvectors of the centred scatter of the vectors it has read. A further
vector is a rank-one change of that scatter: in the eigenbasis a diagonal plus rho z z', whose new eigenvalues are the
roots of the secular equation 1 + rho * sum(z_i^2 / (d_i - t)) = 0, one between any two neighbours of d. Entries of z that
are nothing, and neighbours that are equal, are deflated first: they keep their eigenvalue, after a rotation for the latter.
Vectors of the change are found from a z that is recomputed from the roots, which keeps them orthogonal.

Two spectra are combined by successive rank-one changes: one for each eigenvector of the other, and one for the distance of
the means. Spectra meet in groups of ``FAN_IN`` until one is left, so no task holds more than those. Rayleigh-Ritz
refinement then projects all vectors, exactly centred, on the basis found, sums the projected covariance over all tasks and
solves that small problem; repeated until the basis no longer turns. What passes through the driver has dim x dim numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.storing import discard, stored

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
#: Entries whose scaled value doubles cannot hold as an integer count as not finite.
LARGEST = float(1 << 41)
FAN_IN = 16
ROUNDS = 4
_TINY = 1e-15


def secular_update(values: np.ndarray, vectors: np.ndarray, change: np.ndarray, rho: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues, and eigenvectors (columns), of V diag(values) V' + rho * change change', for rho >= 0.

    ``values`` are ascending and not negative.
    """
    z = vectors.T @ change
    size = float(z @ z)
    if rho * size == 0.0:
        return values, vectors
    z, rho = z / np.sqrt(size), rho * size
    small = _TINY * (abs(values[-1]) + rho) * len(values)
    vectors = vectors.copy()
    # Equal neighbours: a rotation moves all of z into the later one.
    live = np.abs(z) * rho > small
    for i in np.flatnonzero(np.diff(values) <= small):
        if live[i]:
            r = np.hypot(z[i], z[i + 1])
            c, s = z[i + 1] / r, z[i] / r
            z[i], z[i + 1], live[i], live[i + 1] = 0.0, r, False, True
            vectors[:, [i, i + 1]] = vectors[:, [i, i + 1]] @ np.array([[c, s], [-s, c]])
    at = np.flatnonzero(live)
    if not len(at):
        return values, vectors
    d, w = values[at], z[at] ** 2
    k = len(at)
    # Root j lies between d[j] and d[j + 1], the last one up to rho * |z|^2 above d[-1]. Distances are kept from the nearer pole.
    gap = np.append(np.diff(d), rho * w.sum())
    middle = d + gap / 2
    f = 1 + rho * (w / (d - middle[:, None])).sum(axis=1)
    left = (f >= 0) | (np.arange(k) == k - 1)
    pole = np.where(left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    delta = d - d[pole][:, None]
    low, high = np.where(left, 0.0, -gap / 2), np.where(left, np.where(f >= 0, gap / 2, gap), 0.0)
    low = np.where(left & (f < 0), gap / 2, low)
    t = (low + high) / 2
    open_ = np.ones(k, bool)
    for _ in range(60):
        rows = np.flatnonzero(open_)
        if not len(rows):
            break
        x, own = t[rows], pole[rows]
        near = delta[rows] - x[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            part = rho * w / near
            value = 1 + part.sum(axis=1)
            slope = (part / near).sum(axis=1)
            own_part, own_slope = part[np.arange(len(rows)), own], (part / near)[np.arange(len(rows)), own]
            # The equation rises between poles. Its own pole is taken as it is, the rest as a line.
            rest, rest_slope = value - own_part, slope - own_slope
            a, b = rho * w[own], rest - rest_slope * x
            # b + rest_slope * y - a / y = 0 for the distance y from the pole.
            root = np.sqrt(np.maximum(0.0, b * b + 4 * rest_slope * a))
            y = np.where(x > 0, 2 * a / (b + root), 2 * a / (b - root))
        low[rows], high[rows] = np.where(value < 0, x, low[rows]), np.where(value < 0, high[rows], x)
        met = np.abs(value) <= 1e-15 * np.abs(part).sum(axis=1)
        good = np.isfinite(y) & (y >= low[rows]) & (y <= high[rows]) & (y != 0)
        new = np.where(met, x, np.where(good, y, (low[rows] + high[rows]) / 2))
        t[rows] = new
        open_[rows[met | (np.abs(new - x) <= 4e-16 * np.abs(x)) | (high[rows] - low[rows] <= 4e-16 * np.abs(new))]] = False
    # d_i - root_j, without cancellation.
    away = (delta - t[:, None]).T
    apart = d - d[:, None]
    np.fill_diagonal(apart, 1.0)
    # Root j is set against the pole above it for poles up to j, against pole j for those beyond.
    under = np.tri(k, k - 1, -1, dtype=bool)
    ratio = -away
    ratio[:, : k - 1] /= np.where(under, apart[:, : k - 1], apart[:, 1:])
    again = np.sign(z[at]) * np.sqrt(np.abs(np.prod(ratio, axis=1)))
    turned = again[:, None] / away
    turned /= np.sqrt((turned * turned).sum(axis=0))
    values = values.copy()
    values[at] = d[pole] + t
    vectors[:, at] = vectors[:, at] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, mean and scatter (eigenvalues ascending, eigenvectors as columns) of some vectors."""

    def __init__(self, dim: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(dim), np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        """One more vector."""
        self.n += 1
        step = x - self.mean
        self.values, self.vectors = secular_update(self.values, self.vectors, step, (self.n - 1) / self.n)
        self.mean = self.mean + step / self.n

    def combine(self, other: Spectrum) -> None:
        """All vectors of another spectrum."""
        if other.n == 0:
            return
        both = self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = secular_update(self.values, self.vectors, vector, float(value))
        step = other.mean - self.mean
        self.values, self.vectors = secular_update(self.values, self.vectors, step, self.n * other.n / both)
        self.mean, self.n = self.mean + step * (other.n / both), both

    def packed(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @staticmethod
    def unpacked(blob: bytes, dim: int) -> Spectrum:
        flat = np.frombuffer(blob)
        out = Spectrum(dim)
        out.n, out.mean, out.values, out.vectors = int(flat[0]), flat[1 : dim + 1].copy(), flat[dim + 1 : 2 * dim + 1].copy(), flat[2 * dim + 1 :].reshape(dim, dim).copy()
        return out


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``x`` (scaled entries as longs) of the vectors without NULL or non-finite entries."""
    entry = F.col("embedding").cast("array<double>")
    good = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return vectors.where(F.coalesce(good, F.lit(False))).select(
        "vec_id", F.transform(entry, lambda c: (F.floor(c * SCALE) + OFFSET).cast("long")).alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if len(column) else np.zeros((0, dim), np.int64)


def _sums(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """How many vectors, and the exact sum of each entry."""
    def add(batches):
        n, total = 0, [0] * dim
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            # High and low halves, so that no sum leaves 64 bits.
            high, low = (x >> 24).sum(axis=0).tolist(), (x & ((1 << 24) - 1)).sum(axis=0).tolist()
            total = [t + (h << 24) + l for t, h, l in zip(total, high, low)]
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([[str(t) for t in total]])], ["n", "total"])

    exact = F.array(*[F.sum(F.get("total", F.lit(i)).cast("decimal(38,0)")).cast("string") for i in range(dim)])
    n, total = rows.select("x").mapInArrow(add, "n long, total array<string>").agg(F.sum("n"), exact).first()
    return n or 0, [int(t or 0) for t in total]


def _met(partial: DataFrame, together) -> bytes:
    """What the tasks found (``place``, ``found``), brought together ``FAN_IN`` at a time until one is left."""
    def meet(batches):
        for batch in batches:
            for place, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([place], pa.int64()), pa.array([together([f["found"] for f in found])])], ["place", "found"])

    partial = stored(partial)
    while partial.count() > 1:
        before = partial
        group = F.floor(F.col("place") / FAN_IN).cast("long")
        gathered = partial.groupBy(group.alias("place")).agg(F.array_sort(F.collect_list(F.struct(F.col("place").alias("at"), "found"))).alias("found"))
        partial = stored(gathered.mapInArrow(meet, "place long, found binary"))
        discard(before)
    out = bytes(partial.first()["found"])
    discard(partial)
    return out


def _task() -> pa.Array:
    return pa.array([TaskContext.get().partitionId()], pa.int64())


def spectrum(rows: DataFrame, dim: int, centre: np.ndarray) -> Spectrum:
    """The incremental eigendecomposition of all vectors ``x`` (some at least) less ``centre``, a vector near their mean."""
    def grow(batches):
        out = Spectrum(dim)
        for batch in batches:
            for x in _matrix(batch.column(0), dim) - centre:
                out.add(x)
        if out.n:
            yield pa.RecordBatch.from_arrays([_task(), pa.array([out.packed()])], ["place", "found"])

    def together(blobs):
        out = Spectrum.unpacked(blobs[0], dim)
        for blob in blobs[1:]:
            out.combine(Spectrum.unpacked(blob, dim))
        return out.packed()

    return Spectrum.unpacked(_met(rows.select("x").mapInArrow(grow, "place long, found binary"), together), dim)


def _gram(rows: DataFrame, dim: int, basis: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """The covariance of the exactly centred vectors, projected on ``basis``."""
    whole, part = _centre(n, total)
    k = basis.shape[1]

    def project(batches):
        out = np.zeros((k, k))
        for batch in batches:
            y = (_matrix(batch.column(0), dim) - whole - part) @ basis
            out += y.T @ y
        yield pa.RecordBatch.from_arrays([_task(), pa.array([out.tobytes()])], ["place", "found"])

    def together(blobs):
        return sum(np.frombuffer(blob) for blob in blobs).tobytes()

    return np.frombuffer(_met(rows.select("x").mapInArrow(project, "place long, found binary"), together)).reshape(k, k) / n


def _centre(n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole part and rest below one, so that taking it from a vector loses nothing but the rest's last bits."""
    return np.array([t // n for t in total], np.int64), np.array([(t % n) / n for t in total])


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per vector and component: ``vec_id``, ``component`` (from 1, by falling eigenvalue), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``.

    Vectors that are NULL or empty or hold NULL, non-finite or absurd (2^41 and more) entries are dropped; of different
    lengths, the one that most vectors have is taken (the longest of those as common), the others are dropped. Entries become
    longs, floor(1024 c) + 100000. ``deviation`` is the exact sum of (n x - S)^2 over the entries, NULL beyond 64 bits. Where
    an eigenvalue is nothing (one vector, or all alike), ``whitened`` is NULL and the component is left out of the error.
    Repeated rows and ids count as often as they stand, NULL ids too; other columns are ignored; no vectors give no rows.
    """
    result = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = stored(usable(vectors))
    length = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).where("dim > 0").first()
    if length is None:
        empty = rows.select("vec_id").limit(0)
        return empty.selectExpr("vec_id", *[f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in result.split(", ")])
    dim = length["dim"]
    rows = rows.where(F.size("x") == dim)
    n, total = _sums(rows, dim)
    whole, part = _centre(n, total)
    basis = spectrum(rows, dim, whole.astype(float)).vectors[:, ::-1]
    for _ in range(ROUNDS):
        small = _gram(rows, dim, basis, n, total)
        values, turn = np.linalg.eigh((small + small.T) / 2)
        basis = np.linalg.qr(basis @ turn[:, ::-1])[0]
        off = small - np.diag(np.diag(small))
        if np.abs(off).max() <= 1e-14 * np.abs(np.diag(small)).max():
            break
    values = np.maximum(values[::-1], 0.0)
    trace = float(values.sum())
    shown = min(components, dim)
    live = values[:shown] > 1e-13 * trace
    scale = np.where(live, 1 / np.sqrt(np.where(live, values[:shown], 1.0)), 0.0)
    white = basis[:, :shown] * scale
    explained = values[:shown] / trace if trace else np.zeros(shown)
    error = _gram(rows, dim, white, n, total) - np.eye(shown)
    kept = np.flatnonzero(live)
    error = float(np.abs(error[np.ix_(kept, kept)]).max()) if len(kept) else 0.0

    def show(batches):
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            y = (x - whole - part) @ white
            deviation = [sum((n * e - s) ** 2 for e, s in zip(row, total)) for row in x.tolist()]
            keep = pa.array(np.repeat(np.arange(len(x)), shown))
            k = len(x) * shown
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), len(x))), pa.array(np.full(k, n, np.int64)),
                 pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64()).take(keep),
                 pa.array(y.ravel(), mask=np.tile(~live, len(x))), pa.array(np.tile(explained, len(x))), pa.array(np.full(k, error))],
                ["vec_id", *[c.split()[0] for c in result.split(", ")]])

    of_id = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "x").mapInArrow(show, f"vec_id {of_id}, {result}")
