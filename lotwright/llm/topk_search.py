"""Exact top-k search by a three-phase uniform threshold.

The components are cut into ``nodes`` ranges; a vector's score for a query is
the sum of its local scores, one per range.

1. Every block of rows lists, for each query and range, its ``k`` best local
   scores.  The listed rows' whole scores are gathered, and the k-th best of
   them is a safe cutoff: at least k rows reach it.
2. A row whose whole score reaches the cutoff has a local score of at least
   cutoff / nodes in some range (the largest part is at least the mean).  With
   the cutoff sent along, every block collects the rows that have such an entry.
3. The remaining parts of the collected rows are added up exactly; of those
   that reach the cutoff a block returns its ``k`` best, and a window ranks them.

Queries and rows travel in packed blocks of bounded size, and each query block
meets each row block once; nothing is broadcast, as both sides grow with the
table.

Defined results: a vector that is null, holds a null or non-finite component,
or one whose 256-fold does not fit in 31 bits takes no part, nor does a null
id; rows repeated under one id count once (the smallest vector); vectors of
different lengths do not meet; ties go to the smaller id; fewer than ``k``
candidates give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .shipping import shipped

K = 5
NODES = 4
BLOCK_CELLS = 1 << 18       # components in a block of rows or queries
MAX_BLOCK_ROWS = 4096
_LIMIT = 1 << 31

_BLOCK = "dim int, block int, ids array<long>, cells binary"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, dim, v array<int>): floor(256 x) of each usable vector, one row per id."""
    scaled = f"transform(`{vector_col}`, x -> floor(256 * CAST(x AS DOUBLE)))"
    usable = (f"`{id_col}` IS NOT NULL AND `{vector_col}` IS NOT NULL AND forall(`{vector_col}`, x -> "
              f"x IS NOT NULL AND NOT isnan(x) AND abs(256 * CAST(x AS DOUBLE)) < {_LIMIT - 1})")
    rows = vectors.where(usable).selectExpr(f"CAST(`{id_col}` AS BIGINT) AS id",
                                            f"transform({scaled}, x -> CAST(x AS INT)) AS v")
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def _pack(group: pa.Table) -> pa.Table:
    group = group.combine_chunks().sort_by("id")
    dim, block = group["dim"][0].as_py(), group["block"][0].as_py()
    cells = np.asarray(group["v"].combine_chunks().flatten(), dtype="<i4").tobytes()
    return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32()),
                     "ids": pa.array([group["id"].to_pylist()], pa.list_(pa.int64())),
                     "cells": pa.array([cells], pa.binary())})


@shipped
def blocks(rows: DataFrame, name: str) -> DataFrame:
    """Rows packed into blocks of bounded size, numbered 0.. within each length."""
    per = F.least(F.lit(MAX_BLOCK_ROWS), F.greatest(F.lit(16), F.floor(F.lit(BLOCK_CELLS) / F.greatest("dim", F.lit(1)))))
    counts = rows.groupBy("dim").count().withColumn("n_blocks", F.ceil(F.col("count") / per).cast("int")).drop("count")
    numbered = rows.join(counts, "dim").withColumn(
        "block", F.expr("CAST(pmod(xxhash64(id), n_blocks) AS INT)"))
    return materialize(numbered.select("dim", "block", "id", "v").groupBy("dim", "block")
                       .applyInArrow(_pack, _BLOCK), name)


def _matrix(cells: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(cells, dtype="<i4").reshape(n, dim)


def _local_scores(q: np.ndarray, v: np.ndarray, nodes: int) -> list[np.ndarray]:
    """Local score matrices of each component range (exact integers)."""
    dim = q.shape[1]
    edges = np.linspace(0, dim, min(nodes, max(dim, 1)) + 1).astype(int)
    top = float(np.abs(q, dtype=np.float64).max(initial=0)) * float(np.abs(v, dtype=np.float64).max(initial=0)) * max(dim, 1)
    kind = np.float64 if top < 2.0 ** 53 else np.int64      # doubles hold these sums exactly
    return [(q[:, a:b].astype(kind) @ v[:, a:b].astype(kind).T).astype(np.int64)
            for a, b in zip(edges[:-1], edges[1:])]


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score descending, id ascending)."""
    if len(score) > 8 * k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= floor)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))[:k]]


def _search(k: int, nodes: int, resolve: bool):
    """Phase 1 (``resolve`` false) or phases 2 and 3 over pairs of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, v_ids = np.array(row["q_ids"], np.int64), np.array(row["ids"], np.int64)
                q, v = (_matrix(row["q_cells"], len(q_ids), row["dim"]),
                        _matrix(row["cells"], len(v_ids), row["dim"]))
                local = _local_scores(q, v, nodes)
                found: list[tuple[int, int, int]] = []
                for i, query in enumerate(q_ids):
                    if resolve:
                        cutoff = row["cutoffs"][i]
                        entry = np.zeros(len(v_ids), bool)
                        for part in local:
                            entry |= part[i] * len(local) >= cutoff
                        rows = np.flatnonzero(entry & (v_ids != query))
                        whole = sum(part[i][rows] for part in local)       # of the collected rows alone
                        rows, whole = rows[whole >= cutoff], whole[whole >= cutoff]
                        best = _best(whole, v_ids[rows], k)
                        rows, whole = rows[best], whole[best]
                    else:
                        other = np.flatnonzero(v_ids != query)
                        rows = np.unique(np.concatenate(
                            [other[_best(part[i][other], v_ids[other], k)] for part in local]))
                        whole = sum(part[i][rows] for part in local)       # of the listed rows alone
                    found += [(int(query), int(v_ids[r]), int(s)) for r, s in zip(rows, whole)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[j] for f in found], pa.int64()) for j in range(3)],
                    names=["query_id", "vec_id", "score"])
    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = K, nodes: int = NODES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best rows other than its own id.

    ``vectors`` and ``queries`` are tables of (id, dim, v) from ``quantised``.
    """
    kind = "query_id long, vec_id long, score long"
    row_blocks, query_blocks = blocks(vectors, "topk-rows"), blocks(queries, "topk-queries")
    n_blocks = row_blocks.groupBy("dim").agg(F.max("block").alias("last"))

    def meet(qs: DataFrame) -> DataFrame:
        spread = qs.join(n_blocks, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("last")))).drop("last")
        return row_blocks.join(spread, ["dim", "block"])

    asked = query_blocks.select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"),
                                F.col("cells").alias("q_cells"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    listed = meet(asked).mapInArrow(_search(k, nodes, False), kind)
    cutoffs = (listed.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
               .select(F.col("query_id").alias("id"), F.col("score").alias("cutoff")))
    owners = asked.select("dim", "q_block", F.posexplode("q_ids").alias("at", "id"))
    lowest = F.lit(-(1 << 62))
    packed = (owners.join(cutoffs, "id", "left").groupBy("dim", "q_block")
              .agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("cutoff", lowest).alias("c")))).alias("s"))
              .select("dim", "q_block", F.expr("transform(s, x -> x.c)").alias("cutoffs")))
    sent = materialize(asked.join(packed, ["dim", "q_block"]), "topk-cutoffs")
    found = meet(sent).mapInArrow(_search(k, nodes, True), kind)
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
