"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Entries become integers, ``floor(64 * entry) + 1000000``. Three passes over the vectors, each a
partial sum in every task and a sum by key in Spark, give (1) number and exact sums, (2) the scatter
of the centred vectors, (3) the scatter of the whitened ones, centred again, for the
identity error. What reaches the driver is model-sized: d sums and d * (d + 1) / 2 products for vectors
of length d. There ``cholesky`` factors the covariance with diagonal pivoting, and ``jacobi`` turns
the factor's columns until they are orthogonal to each other: their squared norms are the
eigenvalues, the normalised columns the components, and small ones keep their relative accuracy.

``n * x - S`` is computed in integers, so centring loses nothing even where the offset is far
larger than the spread.

Defined cases: rows whose vector is null, or holds a null or non-finite entry, or one that has no
64-bit integer (2^56 or more in size), take no part; a zero vector does, as does a row without an id; repeated rows count
each; vectors of different lengths are whitened apart, each length with its own fit (empty ones
have no components). Components beyond the rank (eigenvalue within rounding of 0, as with one row, equal rows or constant
entries) cannot be scaled to 1 and are left out, so such rows have fewer or none; ``deviation`` is null where it
exceeds 64 bits. A component's sign is that of its largest entry. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000   # fixed values: entry c becomes floor(64 * c) + 1000000
ENTRY_LIMIT = float(1 << 56)    # beyond it, the integer does not fit
LOW_BITS = 24                   # sums are kept in two parts, so that no task's sum overflows
OUT_ROWS = 4096                 # vectors in a result batch
SWEEPS = 60


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v: the vectors that take part, as doubles."""
    rows = vectors.select(vectors[id_col].cast("bigint").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    fits = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < ENTRY_LIMIT))
    return rows.where(F.col("v").isNotNull() & fits & (F.size("v") > 0))


def by_length(batch: pa.RecordBatch):
    """(length, rows, integer vectors) for each vector length in a batch."""
    column = batch.column(batch.schema.get_field_index("v"))
    entries = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE).astype(np.int64) + OFFSET
    lengths = np.asarray(column.value_lengths())
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield int(d), rows, entries[starts[rows][:, None] + np.arange(d)]


@dataclass
class Centre:
    """Number of vectors and their sums, exact. ``n * x - S`` is ``n * (x - base) - rest``, whose parts stay small."""

    n: int
    sums: list[int]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, as 64-bit integers, or Python's where these do not hold it."""
        base, rest = zip(*(divmod(s, self.n) for s in self.sums))
        if max(map(abs, base)) < 1 << 62:
            y = x.astype(np.float64) - np.array(base, dtype=np.float64)
            if not len(y) or self.n * (float(np.abs(y).max()) + 1) < 2.0 ** 62:
                return self.n * (x - np.array(base, dtype=np.int64)) - np.array(rest, dtype=np.int64)
        return self.n * (x.astype(object) - np.array(base, dtype=object)) - np.array(rest, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` in double precision."""
        return self.scaled(x).astype(np.float64) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of ``(n * x - S)^2`` of each vector, exact; None beyond 64 bits."""
        scaled = self.scaled(x)
        about = (scaled.astype(np.float64) ** 2).sum(axis=1)
        small = about < 2.0 ** 62
        out: list[int | None] = [None] * len(x)
        if scaled.dtype != object:
            for i, s in zip(np.flatnonzero(small).tolist(), (scaled[small] ** 2).sum(axis=1).tolist()):
                out[i] = s
        else:
            small[:] = False
        for i in np.flatnonzero(~small & (about < 2.0 ** 63.1)).tolist():
            exact = sum(int(s) ** 2 for s in scaled[i])
            out[i] = exact if exact < 1 << 63 else None
        return out


def cholesky(a: np.ndarray) -> np.ndarray:
    """Columns ``B`` with ``B @ B.T = a`` for a symmetric positive semidefinite ``a``.

    The largest diagonal entry left is the next pivot; ``B`` is lower triangular up to the order of its
    rows. It ends where what is left is within rounding of 0: as many columns as the rank."""
    a = np.array(a, dtype=np.float64)
    d = len(a)
    factor, left, order = np.zeros((d, d)), a.diagonal().copy(), np.arange(d)
    floor = d * np.finfo(np.float64).eps * left.max(initial=0.0)
    for k in range(d):
        p = k + int(np.argmax(left[order[k:]]))
        if left[order[p]] <= floor:
            return factor[:, :k]
        order[[k, p]] = order[[p, k]]
        pivot, rest = order[k], order[k + 1:]
        factor[pivot, k] = np.sqrt(left[pivot])
        factor[rest, k] = (a[rest, pivot] - factor[rest, :k] @ factor[pivot, :k]) / factor[pivot, k]
        left[rest] -= factor[rest, k] ** 2
    return factor


def jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of ``factor @ factor.T``, the largest first.

    One-sided: pairs of columns are rotated until all are orthogonal. A sweep is d - 1 rounds of
    disjoint pairs (a tournament's schedule), each round's rotations at once."""
    b = np.array(factor, dtype=np.float64)
    r = b.shape[1]
    seats = list(range(r + r % 2))      # with an odd number, one seat stays empty
    tolerance = 4 * np.finfo(np.float64).eps
    for _ in range(SWEEPS):
        turned = False
        for _ in range(max(1, len(seats) - 1)):
            pairs = [(p, q) for p, q in zip(seats[:len(seats) // 2], reversed(seats[len(seats) // 2:])) if max(p, q) < r]
            seats = [seats[0], seats[-1], *seats[1:-1]] if seats else seats
            if not pairs:
                continue
            p, q = (np.array(side) for side in zip(*pairs))
            x, y = b[:, p], b[:, q]
            alpha, beta, gamma = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            act = np.abs(gamma) > tolerance * np.sqrt(alpha * beta)
            if not act.any():
                continue
            turned = True
            p, q, x, y = p[act], q[act], x[:, act], y[:, act]
            zeta = (beta[act] - alpha[act]) / (2 * gamma[act])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            b[:, p], b[:, q] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    norms = np.sqrt((b * b).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    values, parts = norms[order] ** 2, b[:, order] / norms[order]
    sign = np.sign(parts[np.argmax(np.abs(parts), axis=0), np.arange(len(order))])
    return values, parts * sign


def _summed(rows: DataFrame, products) -> dict[int, np.ndarray]:
    """Sum of ``products(length, vectors)`` (a matrix) over all vectors, by length: per task, then by entry in Spark."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in by_length(batch):
                made = products(d, x)
                sums[d] = sums[d] + made if d in sums else made
        for d, m in sums.items():
            i, j = np.triu_indices(len(m))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, dtype=np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                              pa.array(m[i, j])], names=["dims", "i", "j", "s"])

    made = rows.mapInArrow(run, "dims int, i int, j int, s double").groupBy("dims", "i", "j").agg(F.sum("s").alias("s"))
    found: dict[int, list] = {}
    for row in made.collect():      # d * (d + 1) / 2 numbers
        found.setdefault(row["dims"], []).append((row["i"], row["j"], row["s"]))
    out = {}
    for d, entries in found.items():
        i, j, s = (np.array(side) for side in zip(*entries))
        out[d] = np.zeros((j.max() + 1, j.max() + 1))
        out[d][i, j] = out[d][j, i] = s
    return out


def _centres(rows: DataFrame) -> dict[int, Centre]:
    def run(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for d, _, x in by_length(batch):
                made = [len(x), (x >> LOW_BITS).sum(axis=0), (x & ((1 << LOW_BITS) - 1)).sum(axis=0)]
                sums[d] = [a + b for a, b in zip(sums[d], made)] if d in sums else made
        for d, (n, high, low) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d, dtype=np.int32)), pa.array(np.arange(d, dtype=np.int32)),
                                              pa.array(np.full(d, n, dtype=np.int64)), pa.array(high), pa.array(low)], names=["dims", "i", "n", "high", "low"])

    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    made = rows.mapInArrow(run, "dims int, i int, n bigint, high bigint, low bigint").groupBy("dims", "i").agg(exact("n"), exact("high"), exact("low"))
    found: dict[int, dict] = {}
    for row in made.collect():      # d rows
        found.setdefault(row["dims"], {})[row["i"]] = (int(row["n"]), (int(row["high"]) << LOW_BITS) + int(row["low"]))
    return {d: Centre(entries[0][0], [entries[i][1] for i in range(d)]) for d, entries in found.items()}


@dataclass
class Whitening:
    """The fit for one vector length."""

    centre: Centre
    values: np.ndarray          # eigenvalues, falling
    parts: np.ndarray           # components as columns
    trace: float
    mean: np.ndarray            # of the whitened vectors: what rounding leaves of 0
    identity_error: float = 0.0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.parts / np.sqrt(self.values))


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each vector length of ``rows`` (as from ``usable``)."""
    centres = _centres(rows)

    def products(d, x):
        """Products of the centred vectors, with a 1 put to each: the last column holds their sums."""
        z = np.column_stack([centres[d].centred(x), np.ones(len(x))])
        return z.T @ z

    fits = {}
    for d, m in _summed(rows, products).items():
        covariance = m[:-1, :-1] / centres[d].n
        values, parts = (a[..., :components] for a in jacobi(cholesky(covariance)))
        mean = m[-1, :-1] / centres[d].n @ (parts / np.sqrt(values))
        fits[d] = Whitening(centres[d], values, parts, float(covariance.trace()), mean)

    def whitened(d, x):
        w = fits[d](x) - fits[d].mean
        return w.T @ w

    for d, m in _summed(rows.where(F.size("v").isin([d for d in fits if len(fits[d].values)])), whitened).items():
        fits[d].identity_error = float(np.abs(m / centres[d].n - np.eye(len(m))).max())
    return fits


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    rows = usable(vectors)
    fits = fit(rows, components)

    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            for d, where, x in by_length(batch):
                model = fits[d]
                k = len(model.values)
                for at in range(0, len(x) if k else 0, OUT_ROWS):
                    part, own = x[at:at + OUT_ROWS], ids.take(pa.array(where[at:at + OUT_ROWS]))
                    m = len(part)
                    each = pa.array(np.repeat(np.arange(m), k))
                    yield pa.RecordBatch.from_arrays([
                        own.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.centre.n, dtype=np.int64)),
                        pa.array(model.centre.deviation(part), pa.int64()).take(each), pa.array(model(part).ravel()),
                        pa.array(np.tile(model.values / model.trace, m)), pa.array(np.full(m * k, model.identity_error))],
                        names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
