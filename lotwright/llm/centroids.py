"""Centroid clustering with heap-ordered bounds, exact in whole numbers.

Vectors are packed once into blocks.  For each block and cluster a binary heap
holds (gap, vector): the gap is the distance to the second nearest centroid
less that to the nearest one, plus the drift that the cluster had accumulated
when the entry was pushed.  A round adds to a cluster's drift its own centroid's
step and the largest step of any other one; an entry whose gap is not above the
drift has expired.  Only expired vectors are popped, scanned against every
centroid exactly, and pushed onto the heap of their cluster again.  Vectors that
change their cluster send their components as differences of the clusters' sums.

Blocks and their heaps are tables bucketed by block: a round reads both without
an exchange, writes the new heaps only, and so starts from written tables after
the loss of an executor.  A round sends the driver one number per cluster and
component.

Defined results: a vector takes part if it has ``dim`` components, none null or
non-finite; components are floor(256 x) of any size.  Rows with a null id are
clustered but are no first centroids.  Repeated rows each count, and equal
hashes go by the vector.  With fewer vectors than ``k`` every one (with an id)
is a centroid; without any the result is empty.  Numbers beyond a long (only
from components beyond 2^28) are null.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .colocated import bucketed, buckets_of
from .exact_sums import PARTS, parts, total
from .shipping import ship

K = 40
DIM = 64
ROUNDS = 5
SEED = "2"
#: Vectors of a block: the heaps of a block are worked on at once.
BLOCK_ROWS = 8192
#: Components below this are worked on as doubles, which hold their products and sums exactly.
NARROW = 1 << 20
_LONG = (1 << 63) - 1

_BLOCK = "block long, ids array<long>, wide boolean, cells binary"
_STATE = ("block long, assigned binary, keys binary, members binary, starts array<int>, "
          f"moved {PARTS}, scanned long")


def usable(vectors: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """(vec_id, v) of the vectors that take part, v as array<double>."""
    whole = (f"size(`{vector_col}`) = {dim} AND forall(`{vector_col}`, x -> x IS NOT NULL AND NOT isnan(x) "
             "AND abs(CAST(x AS DOUBLE)) < CAST('Infinity' AS DOUBLE))")
    return vectors.where(f"`{vector_col}` IS NOT NULL AND {whole}").selectExpr(
        f"CAST(`{id_col}` AS BIGINT) AS vec_id", f"CAST(`{vector_col}` AS ARRAY<DOUBLE>) AS v")


def whole_number(x: float) -> int:
    """floor(256 x), exactly."""
    return math.floor(256 * x) if abs(x) < 2.0 ** 900 else 256 * int(x)


def _pack(dim: int, block_rows: int):
    """Rows to blocks, as the scan brings them: no key decides the size of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a in range(0, batch.num_rows, block_rows):
                part = batch.slice(a, block_rows)
                v = np.asarray(part.column("v").flatten(), dtype=np.float64)
                wide = bool(len(v)) and not np.abs(v).max() < NARROW / 256 - 1
                cells = v if wide else np.floor(v * 256).astype("<i4")      # wide blocks keep the doubles
                ids = part.column("vec_id")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                     pa.array([wide]), pa.array([cells.tobytes()], pa.binary())],
                    names=["block", "ids", "wide", "cells"])
                number += 1
    return run


def _cells(row: dict, dim: int) -> np.ndarray:
    """The block's vectors: doubles that hold whole numbers, or Python integers if wide."""
    if not row["wide"]:
        return np.frombuffer(row["cells"], "<i4").reshape(-1, dim).astype(np.float64)
    flat = np.frombuffer(row["cells"], np.float64)
    return np.array([whole_number(x) for x in flat.tolist()], dtype=object).reshape(-1, dim)


def _two_nearest(x: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (the smaller number of equals) and the squared distances to it and the next."""
    narrow = x.dtype != object and max((abs(c) for row in centroids for c in row), default=0) < NARROW
    c = np.array(centroids, dtype=np.float64 if narrow else object)
    x = x if narrow else x.astype(object)
    if narrow:
        d = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    else:
        x = np.array([[int(y) for y in row] for row in x], dtype=object).reshape(x.shape)
        d = np.array([[sum((a - b) ** 2 for a, b in zip(row, cent)) for cent in centroids] for row in x],
                     dtype=object).reshape(len(x), len(centroids))
    best = np.array([int(np.argmin(row)) for row in d], np.int64) if not narrow else d.argmin(axis=1)
    at = np.arange(len(x))
    first = d[at, best]
    if len(centroids) == 1:
        return best, first, np.full(len(x), np.inf)
    d[at, best] = np.inf if narrow else max((max(r) for r in d), default=0) + 1
    return best, first, d.min(axis=1) if len(d) else first


def _root(square) -> float:
    try:
        return math.sqrt(square)
    except OverflowError:
        return math.inf


def _gaps(first: np.ndarray, second: np.ndarray) -> list[float]:
    """A safe lower bound of each gap: what rounding may add is taken off."""
    out = []
    for a, b in zip(first.tolist(), second.tolist()):
        u, low = _root(a), _root(b)
        gap = low - u - 1e-9 * (low + u) if low < math.inf else (math.inf if u < math.inf else -math.inf)
        out.append(gap)
    return out


def _differences(x: np.ndarray, old: np.ndarray | None, new: np.ndarray, dim: int) -> list[dict]:
    """What the moved vectors add to and take from (cluster, component); component ``dim`` is the count."""
    change: dict[int, int] = {}
    for assigned, sign in ((new, 1), (old, -1)):
        if assigned is None:
            continue
        for c in np.unique(assigned).tolist():
            rows = x[assigned == c]
            sums = [*rows.sum(axis=0).tolist(), len(rows)]
            for i, s in enumerate(sums):
                key = c * (dim + 1) + i
                change[key] = change.get(key, 0) + sign * int(s)
    return parts(change.items())


def _state_row(block: int, assigned: np.ndarray, heaps: list[list], moved: list[dict], scanned: int) -> pa.RecordBatch:
    flat = [e for h in heaps for e in h]
    keys = np.array([e[0] for e in flat], np.float64)
    members = np.array([e[1] for e in flat], np.int32)
    starts = np.concatenate([[0], np.cumsum([len(h) for h in heaps])]).astype(np.int32)
    kind = pa.list_(pa.struct([("key", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([assigned.astype("<i4").tobytes()], pa.binary()),
         pa.array([keys.tobytes()], pa.binary()), pa.array([members.tobytes()], pa.binary()),
         pa.array([starts.tolist()], pa.list_(pa.int32())), pa.array([moved], kind),
         pa.array([scanned], pa.int64())],
        names=["block", "assigned", "keys", "members", "starts", "moved", "scanned"])


def _first_round(centroids: list[list[int]], dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = _cells(row, dim)
                best, first, second = _two_nearest(x, centroids)
                heaps: list[list] = [[] for _ in centroids]
                for i, (c, gap) in enumerate(zip(best.tolist(), _gaps(first, second))):
                    heaps[c].append((gap, i))
                for h in heaps:
                    heapq.heapify(h)
                yield _state_row(row["block"], best, heaps, _differences(x, None, best, dim), len(x))
    return run


def _next_round(centroids: list[list[int]], drift: list[float], dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                assigned = np.frombuffer(row["assigned"], "<i4").astype(np.int64)
                keys, members = np.frombuffer(row["keys"], np.float64).tolist(), np.frombuffer(row["members"], np.int32).tolist()
                starts = row["starts"]
                heaps = [list(zip(keys[a:b], members[a:b])) for a, b in zip(starts[:-1], starts[1:])]
                expired = []
                for heap, limit in zip(heaps, drift):
                    while heap and not heap[0][0] > limit:
                        expired.append(heapq.heappop(heap)[1])
                moved = []
                if expired:
                    some = np.array(expired)
                    x = _cells(row, dim)[some]
                    best, first, second = _two_nearest(x, centroids)
                    for i, c, gap in zip(expired, best.tolist(), _gaps(first, second)):
                        key = gap + drift[c]
                        heapq.heappush(heaps[c], (key if key == key else -math.inf, i))
                    other = best != assigned[some]
                    if other.any():
                        moved = _differences(x[other], assigned[some][other], best[other], dim)
                        assigned[some] = best
                yield _state_row(row["block"], assigned, heaps, moved, len(expired))
    return run


def _distances(row: dict, centroids: list[list[int]], dim: int) -> tuple[np.ndarray, list[int]]:
    """Each vector's cluster and exact squared distance."""
    x, assigned = _cells(row, dim), np.frombuffer(row["assigned"], "<i4")
    if x.dtype != object and max((abs(c) for cent in centroids for c in cent), default=0) < NARROW:
        away = x - np.array(centroids, np.float64)[assigned]
        return assigned, [int(d) for d in (away * away).sum(axis=1).tolist()]
    return assigned, [sum((int(a) - b) ** 2 for a, b in zip(v, centroids[c])) for v, c in zip(x, assigned.tolist())]


def _inertia(centroids: list[list[int]], dim: int):
    kind = pa.list_(pa.struct([("key", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sums: dict[int, int] = {}
                for c, d in zip(*map(list, _distances(row, centroids, dim))):
                    sums[int(c)] = sums.get(int(c), 0) + d
                yield pa.RecordBatch.from_arrays([pa.array([parts(sums.items())], kind)], names=["sums"])
    return run


def _long(number: int) -> int | None:
    return number if abs(number) <= _LONG else None


def _rows(centroids: list[list[int]], inertia: dict[int, int], dim: int):
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    whole = _long(sum(inertia.values()))
    of = [_long(inertia.get(c, 0)) for c in range(len(centroids))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                assigned, away = _distances(row, centroids, dim)
                near = assigned.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(near, pa.int32()),
                     pa.array([_long(d) for d in away], pa.int64()), pa.array([of[c] for c in near], pa.int64()),
                     pa.array([whole] * len(near), pa.int64()), pa.array([digests[c] for c in near], pa.string())],
                    names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])
    return run


def _steps(before: list[list[int]], after: list[list[int]]) -> list[float]:
    """How far each centroid went, rounded up."""
    return [_root(sum((a - b) ** 2 for a, b in zip(x, y))) * (1 + 1e-12) for x, y in zip(before, after)]


class Clustering:
    """Result of ``cluster``: centroids, the blocks with their last heaps, and the vectors scanned in each round."""

    def __init__(self, centroids, blocks, state, scanned, dim):
        self.centroids, self.blocks, self.state, self.scanned, self.dim = centroids, blocks, state, scanned, dim

    def rows(self) -> DataFrame:
        """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per vector."""
        kind = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
        if not self.centroids:
            return self.blocks.sparkSession.createDataFrame([], kind)
        both = self.blocks.join(self.state.select("block", "assigned"), "block")
        inertia = total(both.mapInArrow(_inertia(self.centroids, self.dim), f"sums {PARTS}"), "sums")
        return both.mapInArrow(_rows(self.centroids, dict(inertia), self.dim), kind)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, seed: str = SEED,
            id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> Clustering:
    """Cluster ``vectors``: ``rounds`` of assigning and moving the centroids, and one more assignment."""
    spark = vectors.sparkSession
    ship(spark)
    kept = usable(vectors, id_col, vector_col, dim)
    first = (kept.where("vec_id IS NOT NULL")
             .withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
             .orderBy("h", "v").limit(k).collect())
    centroids = [[whole_number(x) for x in r["v"]] for r in first]
    n = buckets_of(vectors)
    blocks = bucketed(kept.mapInArrow(_pack(dim, block_rows), _BLOCK), "block", "cluster_blocks", n)
    if not centroids:
        return Clustering([], blocks, None, [], dim)

    def written(df: DataFrame) -> DataFrame:
        return bucketed(df, "block", "cluster_heaps", n)

    state = written(blocks.mapInArrow(_first_round(centroids, dim), _STATE))
    drift = [0.0] * len(centroids)
    sums = [[0] * (dim + 1) for _ in centroids]
    scanned = [state.agg(F.sum("scanned")).first()[0]]
    for _ in range(rounds):
        for key, value in total(state, "moved").items():
            sums[key // (dim + 1)][key % (dim + 1)] += value
        moved = [[x // s[dim] for x in s[:dim]] if s[dim] else c for s, c in zip(sums, centroids)]
        steps = _steps(centroids, moved)
        for j in range(len(drift)):
            drift[j] += steps[j] + max((p for i, p in enumerate(steps) if i != j), default=0.0)
        centroids = moved
        before = state.select("block", "assigned", "keys", "members", "starts")
        state = written(blocks.join(before, "block").mapInArrow(_next_round(centroids, drift, dim), _STATE))
        scanned.append(state.agg(F.sum("scanned")).first()[0])
    return Clustering(centroids, blocks, state, scanned, dim)


def report(vectors: DataFrame, **options) -> DataFrame:
    """The rows of ``cluster``, written once."""
    return materialize(cluster(vectors, **options).rows(), "clusters")
