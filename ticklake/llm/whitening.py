"""Whitening of embedding vectors by mixed-precision eigenvectors (operator 11).

Vectors are scaled to whole numbers, so that sums and sums of products are exact whatever their order: a first pass
counts and adds them up, a second one adds up products of deviations from the means rounded to whole numbers, and
what rounding left over is taken off exactly. So the covariance is the same after every run, and centred before
anything is multiplied.

Its eigenvectors are found in float32 and then corrected by Ogita and Aishima's iteration, which is made of products of
matrices in extended precision: with R = I - X'X and S = X'AX, an eigenvalue is s_ii / (1 - r_ii) and a vector's
share in another one's correction (s_ij + w_j r_ij) / (w_j - w_i). Eigenvalues nearer to each other than the error of
that (clusters, as float32 leaves many) would blow it up: there the iteration only restores orthogonality, and a
cluster's own matrix, shifted by its mean so that its small differences keep their digits, is solved apart and turns
the cluster's vectors. Iterations repeat until corrections vanish beside double precision.

What reaches the driver are one matrix of dimension x dimension per vector length and sums of such shape; rows are
projected where they are read. A last pass over the whitened vectors measures their covariance.

Edge cases: vectors that are NULL, empty, or hold NULL or non-finite entries are dropped; zero vectors, repeated rows and
rows with a NULL or repeated id are rows like any other. Vectors of different length are whitened apart, each
length by its own rows. Components without variance (fewer rows than dimensions, constant entries) can't be scaled:
they come last, whitened to 0, and aren't part of the identity error. Entries beyond 2^40 times the scale are refused,
as their products wouldn't be exact. An empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
ROUNDS = 40  # of the iteration, at most
LARGEST = 1 << 46  # of whole numbers
EXACT = 1 << 53  # whole numbers that a double holds
WIDE = np.longdouble
NEAR = 1e-10  # eigenvalues nearer than this share of the largest are always a cluster: noise over a smaller gap would grow
DROP = 1e-13  # eigenvalues up to this share of the largest count as no variance


def whole(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By length: rows that take part, and their vectors as whole numbers around zero (``SHIFT`` left out)."""
    lists = column.cast(pa.large_list(pa.float64()))
    length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    for size in np.unique(length[length > 0]):
        row = np.flatnonzero(length == size)
        v = lists.take(pa.array(row)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(row), size)
        ok = np.isfinite(v).all(1)
        v = np.floor(SCALE * v[ok])
        if len(v):
            if np.abs(v).max() > LARGEST:
                raise ValueError(f"Entries beyond {LARGEST / SCALE:g} can't be whitened exactly")
            yield int(size), row[ok], v.astype(np.int64)


def _sums(rows: DataFrame, work, shape) -> dict[int, tuple[int, np.ndarray]]:
    """By length: number of rows and exact sums, of arrays of whole numbers that ``work`` makes of vectors.

    A task adds up its own rows and gives one row for each line of the sums; lines are added up by key.
    Both halves of a number travel apart, so that no sum leaves 64 bits.
    """

    def run(batches):
        have: dict[int, list] = {}
        for batch in batches:
            for size, _, x in whole(batch.column("embedding")):
                own = have.setdefault(size, [0, np.zeros(shape(size), object)])
                own[0] += len(x)
                own[1] = own[1] + work(size, x)
        for size, (n, total) in have.items():
            total = total.reshape(-1, size)
            high = [[int(v) >> 32 for v in line] for line in total]
            low = [[int(v) & 0xFFFFFFFF for v in line] for line in total]
            k = len(total)
            columns = [np.full(k, size), np.arange(k), np.full(k, n)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns), pa.array(high, pa.list_(pa.int64())), pa.array(low, pa.list_(pa.int64()))],
                ["size", "line", "n", "high", "low"],
            )

    parts = rows.mapInArrow(run, "size long, line long, n long, high array<long>, low array<long>")
    entries = parts.select("size", "line", "n", F.posexplode(F.arrays_zip("high", "low")).alias("place", "half"))
    added = entries.groupBy("size", "line", "place").agg(F.sum("n").alias("n"), F.sum("half.high").alias("high"), F.sum("half.low").alias("low"))
    out: dict[int, tuple[int, np.ndarray]] = {}
    for r in added.toLocalIterator():
        if r.size not in out:
            out[r.size] = (r.n, np.zeros(shape(r.size), object))
        out[r.size][1].reshape(-1, r.size)[r.line, r.place] = (r.high << 32) + r.low
    return out


def products(y: np.ndarray) -> np.ndarray:
    """Exact y'y of whole numbers."""
    largest = int(np.abs(y).max(initial=0))
    total = np.zeros((y.shape[1], y.shape[1]), object)
    if largest * largest >= EXACT:
        # In pieces of few bits, whose products and sums a double holds.
        low = y & 0xFFFF
        mid = (y >> 16) & 0xFFFF
        digits = [low, mid, y >> 32]
        for i, a in enumerate(digits):
            for j, b in enumerate(digits):
                for lo in range(0, len(y), 1 << 16):
                    some = (a[lo : lo + (1 << 16)].T.astype(np.float64) @ b[lo : lo + (1 << 16)].astype(np.float64)).astype(np.int64)
                    total = total + (some.astype(object) << 16 * (i + j))
        return total
    step = max(1, EXACT // max(1, largest * largest))
    for lo in range(0, len(y), step):
        part = y[lo : lo + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def extended(values: np.ndarray) -> np.ndarray:
    """Whole numbers of any size in extended precision."""
    high = values.astype(np.float64)
    low = (values - np.vectorize(int, otypes=[object])(high)).astype(np.float64) if values.size else high
    return high.astype(WIDE) + low.astype(WIDE)


def eigen(matrix: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and their unit vectors (columns) of a symmetric matrix in extended precision."""
    n = len(matrix)
    scale = np.abs(matrix).max(initial=0)
    if not n or scale == 0:
        return np.zeros(n, WIDE), np.eye(n, dtype=WIDE)
    a = matrix / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    one, small_change = np.eye(n, dtype=WIDE), np.finfo(np.float64).eps / 8
    norm = np.linalg.norm(a.astype(np.float64), 2)
    noise = 4 * n * float(np.finfo(WIDE).eps) * norm
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ a @ x
        w = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-w, kind="stable")
        x, w, r, s = x[:, order], w[order], r[order][:, order], s[order][:, order]
        off = np.linalg.norm((s - np.diag(w)).astype(np.float64), 2)
        near = max(2 * (off + norm * np.linalg.norm(r.astype(np.float64), 2)), NEAR * norm)
        gap = w[None, :] - w[:, None]
        apart = np.abs(gap) > near
        e = np.where(apart, (s + w[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        # Clusters: neighbours that are not apart, solved by their own shifted matrix.
        cuts = np.flatnonzero(w[:-1] - w[1:] > near) + 1
        turned = False
        for lo, hi in zip([0, *cuts], [*cuts, n], strict=True):
            if hi - lo > 1:
                own = x[:, lo:hi]
                centre = w[lo:hi].mean()
                small = own.T @ (a @ own - centre * own)
                small = ((small + small.T) / 2).astype(np.float64)
                # Below the noise of extended precision the vectors are as good as any others of their space.
                if np.abs(small - np.diag(np.diag(small))).max() > noise:
                    x[:, lo:hi] = own @ np.linalg.eigh(small)[1][:, ::-1].astype(WIDE)
                    turned = True
        if not turned and np.abs(e).max() < small_change:
            break
    x = x + x @ (one - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(0))
    w = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-w, kind="stable")
    return w[order] * scale, x[:, order]


class Whitening:
    """What turns vectors of one length into whitened ones."""

    def __init__(self, n: int, sums: np.ndarray, centres: np.ndarray, moments: np.ndarray, components: int):
        self.n = n
        rest = sums - n * centres  # what rounding the means left over
        covariance = extended(n * moments - np.outer(rest, rest)) / WIDE(n) / WIDE(n)
        values, vectors = eigen(covariance)
        count = min(components, len(values))
        trace = np.trace(covariance)
        self.centres = centres.astype(np.int64)
        self.rest = rest
        self.explained = (values[:count] / trace if trace > 0 else values[:count] * 0).astype(np.float64)
        # A component has variance where its eigenvalue stands out of the largest one's error.
        self.known = values[:count] > max(values.max(initial=0) * DROP, 0)
        scale = np.where(self.known, 1 / np.sqrt(np.where(self.known, values[:count], 1)), 0)
        self.vectors = vectors[:, :count].astype(np.float64)
        self.scale = scale.astype(np.float64)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n times each entry less its column's sum, exactly."""
        y = x - self.centres
        if int(np.abs(y).max(initial=0)) * self.n + max(map(abs, self.rest.tolist()), default=0) < 1 << 62:
            return self.n * y - self.rest.astype(np.int64)
        return self.n * y.astype(object) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x).astype(np.float64) / self.n) @ self.vectors * self.scale

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum of squares of a row's deviations, exactly."""
        d = self.deviations(x)
        if d.dtype == object or int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] >= 1 << 62:
            d = d.astype(object)
        return (d * d).sum(1).tolist()


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """By length of vectors: their whitening, from all rows of ``vectors`` (embedding)."""
    rows = vectors.select("embedding")
    sums = _sums(rows, lambda size, x: x.astype(object).sum(0) if int(np.abs(x).max()) * len(x) >= 1 << 62 else x.sum(0).astype(object), lambda size: (size,))
    centres = {size: np.array([(2 * int(s) + n) // (2 * n) for s in total], object) for size, (n, total) in sums.items()}
    means = {size: c.astype(np.int64) for size, c in centres.items()}
    moments = _sums(rows, lambda size, x: products(x - means[size]), lambda size: (size, size))
    return {size: Whitening(n, total, centres[size], moments[size][1], components) for size, (n, total) in sums.items()}


def identity_errors(vectors: DataFrame, fitted: dict[int, Whitening]) -> dict[int, float]:
    """By length: the largest entry of the whitened vectors' covariance less the identity, measured on all rows."""

    def run(batches):
        have: dict[int, list] = {}
        for batch in batches:
            for size, _, x in whole(batch.column("embedding")):
                w = fitted[size].whitened(x)[:, fitted[size].known]
                k = w.shape[1]
                own = have.setdefault(size, [np.zeros(k), np.zeros((k, k))])
                own[0] += w.sum(0)
                own[1] += w.T @ w
        for size, (total, gram) in have.items():
            lines = np.concatenate([total[None, :], gram])
            k = len(lines)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, size)), pa.array(np.arange(k)), pa.array(lines.tolist(), pa.list_(pa.float64()))], ["size", "line", "v"])

    parts = vectors.select("embedding").mapInArrow(run, "size long, line long, v array<double>")
    added = parts.select("size", "line", F.posexplode("v").alias("place", "v")).groupBy("size", "line", "place").agg(F.sum("v").alias("v"))
    sums = {size: np.zeros((int(f.known.sum()) + 1, int(f.known.sum()))) for size, f in fitted.items()}
    for r in added.toLocalIterator():
        sums[r.size][r.line, r.place] = r.v
    out = {}
    for size, f in fitted.items():
        mean, gram = sums[size][0] / f.n, sums[size][1:] / f.n
        out[size] = float(np.abs(gram - np.outer(mean, mean) - np.eye(len(gram))).max(initial=0))
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation (decimal), whitened, explained, identity_error."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fitted = fit(rows, components)
    errors = identity_errors(rows, fitted)

    def run(batches):
        for batch in batches:
            for size, row, x in whole(batch.column("embedding")):
                f = fitted[size]
                w = f.whitened(x)
                k = w.shape[1]
                ids = batch.column("vec_id").take(pa.array(np.repeat(row, k)))
                deviation = pa.array([decimal.Decimal(d) for d in f.deviation(x)], pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(len(x)), k)))
                columns = [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(ids), f.n)),
                    deviation,
                    pa.array(w.ravel()),
                    pa.array(np.tile(f.explained, len(x))),
                    pa.array(np.full(len(ids), errors[size])),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, schema)
