"""Embedding whitening: components of the exact covariance by FEAST contour integration.

1. Spark adds up the whole-number vectors and, centred on whole numbers next to
   the mean, their products: n, sums and covariance are exact.
2. The covariance (one small matrix per vector length) is cut into intervals
   of the spectrum that hold few eigenvalues, counted by the inertia of shifted
   LDL' factorisations.  On each interval FEAST applies a rational filter, the
   Gauss-Legendre quadrature of complex shifted solves around a circle, to a
   random subspace; Rayleigh-Ritz extracts the vectors, again and again until
   the residuals are at rounding level.  The number found must be the inertia
   count, else the interval is halved.
3. Every vector is projected on the components in one pass, after a pass that
   measures the covariance of the result.

Defined results: a vector that is null or holds a null or non-finite entry is
dropped, and so is an empty one.  Each length of vectors is a list of its own,
with its own n and components.  Entries beyond a long take the nearest long.
Components with an eigenvalue of zero (to double precision) are not returned,
so a single vector or equal vectors give no rows.  Repeated rows and null ids
each give rows.  A deviation beyond a long is null.  An empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exact_sums import PARTS, parts, total
from .shipping import ship

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
#: Eigenvalues of an interval of the spectrum, nodes of its contour, and rounds of the filter.
MAX_IN_INTERVAL = 12
NODES = 8
MAX_FILTERS = 12
#: Rows that a task multiplies at once; whole numbers below NARROW stay exact in doubles.
CHUNK_ROWS = 4096
NARROW = 1 << 20
_LONG = (1 << 63) - 1
_PARTS = pa.list_(pa.struct([("key", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())]))


# ---------------------------------------------------------------------------
# Symmetric eigenvalue problem on an interval.
# ---------------------------------------------------------------------------
def count_below(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of symmetric ``v`` below ``shift``: negative pivots of LDL' of v - shift I.

    A pivot of the size of rounding is no sign: its eigenvalue is the shift."""
    a = v - shift * np.eye(len(v))
    rounding = len(a) * np.finfo(float).eps * np.abs(v).max(initial=abs(shift))
    alpha, below = (1 + math.sqrt(17)) / 8, 0
    while len(a):
        diagonal, off = np.abs(np.diag(a)), np.abs(np.tril(a, -1))
        i = int(diagonal.argmax())
        r, s = divmod(int(off.argmax()), len(a))
        if diagonal[i] == 0 and off[r, s] == 0:
            break
        pivots = [i] if diagonal[i] >= alpha * off[r, s] else [s, r]       # of one row or two
        rest = np.setdiff1d(np.arange(len(a)), pivots)
        d, e = a[np.ix_(pivots, pivots)], a[np.ix_(rest, pivots)]
        below += int(d[0, 0] < -rounding) if len(pivots) == 1 else 1               # two: one of each sign
        a = a[np.ix_(rest, rest)] - e @ np.linalg.solve(d, e.T)
        a = (a + a.T) / 2
    return below


def _contour(v: np.ndarray, low: float, high: float, y: np.ndarray, nodes: int) -> np.ndarray:
    """The filter of [low, high] applied to ``y``: half of the circle is enough for a real matrix."""
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    out = np.zeros_like(y)
    for t, w in zip(points, weights):
        turn = np.exp(1j * math.pi / 2 * (1 - t))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(v)) - v, y.astype(complex))
        out += w / 2 * (radius * turn * solved).real
    return out


def _rayleigh_ritz(v: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q, _ = np.linalg.qr(y)
    values, inner = np.linalg.eigh(q.T @ v @ q)
    return values, q @ inner


def feast(v: np.ndarray, low: float, high: float, count: int, seed: int = 0, nodes: int = NODES) -> np.ndarray | None:
    """The ``count`` eigenvectors of ``v`` with eigenvalues in [low, high), or None if they don't show."""
    size = min(len(v), max(count + 4, math.ceil(1.5 * count)))
    y = np.random.default_rng(seed).standard_normal((len(v), size))
    norm = np.abs(v).sum(axis=1).max()
    for _ in range(MAX_FILTERS):
        values, x = _rayleigh_ritz(v, _contour(v, low, high, y, nodes))
        inside = (values >= low) & (values < high)
        found = x[:, inside]
        if found.shape[1] == count:
            error = np.linalg.norm(v @ found - found * values[inside], axis=0).max(initial=0)
            if error <= 1e-14 * norm * math.sqrt(len(v)):
                return found
        y = x
    return None


def _cut(v: np.ndarray, low: float, high: float) -> tuple[float, int] | None:
    """A shift near the middle that no eigenvalue touches, and the count below it."""
    for part in (0.5, 0.47, 0.53, 0.42, 0.58, 0.36, 0.64, 0.28, 0.72):
        at = low + part * (high - low)
        slack = 1e-11 * max(abs(low), abs(high))
        below = count_below(v, at - slack)
        if below == count_below(v, at + slack):
            return at, below
    return None


def top_components(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns): up to ``most``, zeros left out."""
    d, trace = len(v), float(np.trace(v))
    if not trace > 0:
        return np.zeros(0), np.zeros((d, 0))
    scale = trace / d
    v = v / scale                                        # entries near one, whatever the unit
    floor = d * 2.0 ** -50 * float(np.abs(v).sum(axis=1).max())
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9) + 1e-300
    wanted = min(most, d - count_below(v, floor))
    low, high = floor, top
    for _ in range(60):                                  # the lowest shift that still has `wanted` above it
        if d - count_below(v, low) <= wanted + 4 or high - low <= 1e-9 * top:
            break
        middle = _cut(v, low, high)
        if middle is None:
            break
        low, high = (middle[0], high) if d - middle[1] >= wanted else (low, middle[0])
    todo, found = [(low, top, d - count_below(v, low))], []
    expected = todo[0][2]
    while todo:
        a, b, count = todo.pop()
        if not count:
            continue
        if count <= MAX_IN_INTERVAL or b - a <= 1e-9 * top:
            x = feast(v, a, b, count, seed=len(found))
            if x is not None:
                found.append(x)
                continue
        middle = _cut(v, a, b) if b - a > 1e-12 * top else None
        if middle is None:                               # too close to be parted: a wide contour, many nodes
            x = feast(v, a - (b - a) - 1e-12 * top, b, d - count_below(v, a - (b - a) - 1e-12 * top) - (d - count_below(v, b)),
                      seed=len(found), nodes=4 * NODES)
            if x is None:
                raise ArithmeticError(f"no components between {a} and {b}")
            found.append(x)
            continue
        below = middle[1] - (d - (d - count_below(v, a)))
        todo += [(a, middle[0], below), (middle[0], b, count - below)]
    if not found:
        return np.zeros(0), np.zeros((d, 0))
    values, x = _rayleigh_ritz(v, np.concatenate(found, axis=1))
    if len(values) != expected:
        raise ArithmeticError(f"{len(values)} components, but the inertia says {expected}")
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order] * scale, x[:, order]


# ---------------------------------------------------------------------------
# Exact statistics, projection.
# ---------------------------------------------------------------------------
def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, dim, v array<double>) of the vectors that take part."""
    whole = (f"forall(`{vector_col}`, x -> x IS NOT NULL AND NOT isnan(x) AND "
             "abs(CAST(x AS DOUBLE)) < CAST('Infinity' AS DOUBLE))")
    return vectors.where(f"`{vector_col}` IS NOT NULL AND size(`{vector_col}`) > 0 AND {whole}").selectExpr(
        f"CAST(`{id_col}` AS BIGINT) AS vec_id", f"size(`{vector_col}`) AS dim",
        f"CAST(`{vector_col}` AS ARRAY<DOUBLE>) AS v")


def _numbers(v: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1000000: int64, or Python integers where that is near the end of a long."""
    scaled = np.floor(v * SCALE)                          # exact, or infinite
    if not len(scaled) or np.abs(scaled).max() < 2.0 ** 52:
        return scaled.astype(np.int64) + OFFSET
    big = [(_LONG if x > 0 else -_LONG - 1) if math.isinf(x) else int(x) + OFFSET for x in scaled.ravel().tolist()]
    return np.array([max(-_LONG - 1, min(_LONG, x)) for x in big], dtype=object).reshape(v.shape)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(length, ids, whole-number vectors) in chunks of rows."""
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        rows = batch.filter(pa.array(dims == dim)) if (dims != dim).any() else batch
        for a in range(0, rows.num_rows, CHUNK_ROWS):
            part = rows.slice(a, CHUNK_ROWS)
            v = np.asarray(part.column("v").flatten(), dtype=np.float64).reshape(-1, dim)
            yield dim, part.column("vec_id"), _numbers(v)


def _emit(dim: int, numbers) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([parts(numbers)], _PARTS)],
                                      names=["dim", "sums"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and length: the components' sums, and the count under the key ``dim``."""
    have: dict[int, list[int]] = {}
    for batch in batches:
        for dim, _, x in _by_length(batch):
            sums = have.setdefault(dim, [0] * (dim + 1))
            for i, s in enumerate([*(int(y) for y in x.astype(object).sum(axis=0) if x.dtype == object)]
                                  if x.dtype == object else x.sum(axis=0).tolist()):
                sums[i] += s
            sums[dim] += len(x)
    for dim, sums in have.items():
        yield _emit(dim, enumerate(sums))


def _centred(x: np.ndarray, middle: list[int]) -> np.ndarray:
    """x less whole numbers next to the mean: doubles where they and their products are exact."""
    if x.dtype != object and max(map(abs, middle)) < 1 << 61:
        y = x - np.array(middle, np.int64)
        if not len(y) or np.abs(y).max() < NARROW:
            return y.astype(np.float64)
    return np.array([[int(a) - b for a, b in zip(row, middle)] for row in x], dtype=object).reshape(x.shape)


def _products(middles: dict[int, list[int]]):
    """Per task and length: sums of products of centred components, key i * dim + j with i <= j."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch):
                y = _centred(x, middles[dim])
                gram = y.T @ y                           # below 2^53: NARROW^2 * CHUNK_ROWS
                gram = gram.astype(np.int64).astype(object) if gram.dtype != object else gram
                have[dim] = have[dim] + gram if dim in have else gram
        for dim, gram in have.items():
            yield _emit(dim, ((i * dim + j, int(gram[i, j])) for i in range(dim) for j in range(i, dim)))
    return run


@dataclass
class Fit:
    """Whitening of vectors of one length."""
    n: int
    sums: list[int]
    middle: list[int]              # whole numbers next to the mean
    rest: np.ndarray               # mean less middle
    values: np.ndarray             # eigenvalues, falling
    vectors: np.ndarray            # unit eigenvectors as columns
    explained: np.ndarray

    def whiten(self, x: np.ndarray) -> np.ndarray:
        y = _centred(x, self.middle).astype(np.float64) - self.rest
        return (y @ self.vectors) / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the components of (n x - S)^2."""
        y = _centred(x, self.middle)
        left = [s - self.n * m for s, m in zip(self.sums, self.middle)]
        most = int(np.abs(y).max(initial=0)) * self.n + max(map(abs, left))
        if y.dtype != object and most * most * max(1, y.shape[1]) < _LONG:
            away = y.astype(np.int64) * self.n - np.array(left, np.int64)
            return (away * away).sum(axis=1).tolist()
        exact = [sum((self.n * int(a) - b) ** 2 for a, b in zip(row, left)) for row in y]
        return [d if d <= _LONG else None for d in exact]


def fit(rows: DataFrame, most: int = COMPONENTS) -> dict[int, Fit]:
    """The whitening of each length of vectors in ``rows`` (from ``usable``)."""
    found: dict[int, dict[int, int]] = {}
    for (dim, key), s in total(rows.mapInArrow(_sums, f"dim int, sums {PARTS}"), "sums", ["dim"]).items():
        found.setdefault(dim, {})[key] = s
    count = {d: s[d] for d, s in found.items()}
    sums = {d: [s.get(i, 0) for i in range(d)] for d, s in found.items()}
    middles = {d: [(2 * s + count[d]) // (2 * count[d]) for s in sums[d]] for d in found}
    grams: dict[int, dict[int, int]] = {}
    for (dim, key), s in total(rows.mapInArrow(_products(middles), f"dim int, sums {PARTS}"), "sums", ["dim"]).items():
        grams.setdefault(dim, {})[key] = s
    out = {}
    for dim, n in count.items():
        left = [s - n * m for s, m in zip(sums[dim], middles[dim])]
        v = np.zeros((dim, dim))
        gram = grams.get(dim, {})
        for i in range(dim):
            for j in range(i, dim):                      # one rounding, in the division
                v[i, j] = v[j, i] = (n * gram.get(i * dim + j, 0) - left[i] * left[j]) / (n * n)
        values, vectors = top_components(v, most)
        trace = float(np.trace(v))
        out[dim] = Fit(n, sums[dim], middles[dim], np.array([x / n for x in left]), values, vectors,
                       values / trace if trace else values)
    return out


def _moments(fits: dict[int, Fit]):
    """Per task and length: count, sums and products of the whitened components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, list] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch):
                w = fits[dim].whiten(x)
                new = [w.sum(axis=0), w.T @ w]
                have[dim] = [a + b for a, b in zip(have[dim], new)] if dim in have else new
        for dim, (s, g) in have.items():
            flat = np.concatenate([s, g.ravel()])
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([flat.tolist()], pa.list_(pa.float64()))], names=["dim", "m"])
    return run


def identity_errors(rows: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Largest entry of |covariance of the whitened vectors - identity|, measured over all rows."""
    flat = rows.mapInArrow(_moments(fits), "dim int, m array<double>").select("dim", F.posexplode("m").alias("at", "x"))
    sums: dict[int, dict[int, float]] = {}
    for r in flat.groupBy("dim", "at").agg(F.sum("x").alias("x")).collect():
        sums.setdefault(r["dim"], {})[r["at"]] = r["x"]
    out = {}
    for dim, m in sums.items():
        q, n = len(fits[dim].values), fits[dim].n
        flat_m = np.array([m[i] for i in range(q + q * q)])
        mean = flat_m[:q] / n
        out[dim] = float(np.abs(flat_m[q:].reshape(q, q) / n - np.outer(mean, mean) - np.eye(q)).max(initial=0))
    return out


def _project(fits: dict[int, Fit], errors: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, ids, x in _by_length(batch):
                f = fits[dim]
                q, rows = len(f.values), len(x)
                if not q:
                    continue
                each = np.repeat(np.arange(rows), q)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, q + 1, dtype=np.int32), rows)),
                     pa.array(np.full(rows * q, f.n)), pa.array(f.deviation(x), pa.int64()).take(pa.array(each)),
                     pa.array(f.whiten(x).ravel()), pa.array(np.tile(f.explained, rows)),
                     pa.array(np.full(rows * q, errors[dim]))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component.

    The driver holds one matrix per vector length, never rows of the table.
    """
    ship(vectors.sparkSession)
    rows = usable(vectors, id_col, vector_col)
    fits = fit(rows, most)
    errors = identity_errors(rows, fits)
    return rows.mapInArrow(_project(fits, errors), "vec_id long, component int, n long, deviation long, "
                           "whitened double, explained double, identity_error double")
