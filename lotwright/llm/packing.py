"""Conflict-constrained best-fit packing of documents into fixed-length sequences.

A document longer than the capacity is cut into pieces; whole pieces fill a
bin of their own, the rest is packed.  A bin never holds two pieces of one
source, of one duplicate cluster or of one document.  The clusters are the
components of near duplicates (five-word shingles, similarity 0.8 or more).

Pieces are dealt by a hash into groups of about ``GROUP_ITEMS``, so a source or
cluster that holds a third of all rows is spread evenly.  Equal pieces are
counted first and travel as bundles of at most ``BUNDLE``, dealt one by one, so
rows that repeat very often are spread as well and every group is one small task.  Inside a group, pieces go
longest first.  Open bins are kept ordered by residual; each carries a bitmap
of its sources, clusters and documents.  The successor search starts at the
first bin with room and continues until a compatible one is found, which is
the tightest; if there is none, a bin is opened.

Defined results: null or empty texts are pieces of length 0 and are packed
too; a null source or cluster conflicts with nothing; equal lengths go by
doc_id, piece, source and cluster; repeated rows are packed each (rows of one
doc_id never share a bin); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .near_dedup import with_components
from .shipping import shipped

CAPACITY = 2048
GROUP_ITEMS = 4096
BUNDLE = 16
_SCAN = 256

#: Ids may repeat or be null, so a row is named by its id and text.
_KEY = "xxhash64(CAST(doc_id AS BIGINT), lower(text))"
_PACKED = "doc_id long, piece int, start long, n_words long, bin_id long"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, n, cluster): words and near-duplicate component, in lower case, of every document.

    A document without words has no cluster.
    """
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"))
    lowered = docs.select(F.lower("text").alias("text"), F.expr(_KEY).alias("doc_id"), own.alias("own"))
    near = with_components(lowered, "own", size=5, percent=80)
    return near.select("own.doc_id", "own.source", F.col("n_words").alias("n"), F.col("component_id").alias("cluster"))


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, n_words, source, cluster): pieces of at most ``capacity`` words.

    The cluster of a document is its component of near duplicates; copies that
    differ in white space or case are one cluster, too.
    """
    cut = sized(docs).withColumn("piece", F.explode(F.expr(
        f"sequence(0, CAST(greatest(ceil(n / {capacity}) - 1, 0) AS INT))")))
    return cut.selectExpr("doc_id", "piece", f"CAST(piece AS BIGINT) * {capacity} AS start",
                          f"least(n - CAST(piece AS BIGINT) * {capacity}, {capacity}) AS n_words", "source", "cluster")


class _Conflicts:
    """Bit positions of values that occur twice or more in a group; others cannot conflict."""

    def __init__(self, columns: list[np.ndarray]):
        self.bits = np.full((len(columns[0]), len(columns)), -1, np.int64)
        used = 0
        for j, codes in enumerate(columns):
            known = codes >= 0
            count = np.bincount(codes[known]) if known.any() else np.zeros(0, np.int64)
            number = np.cumsum(count >= 2) - 1 + used
            shared = np.flatnonzero(known)[count[codes[known]] >= 2] if known.any() else np.zeros(0, np.int64)
            self.bits[shared, j] = number[codes[shared]]
            used += int((count >= 2).sum())
        self.words = max(1, -(-used // 64))


def best_fit(lengths: np.ndarray, conflicts: list[np.ndarray], capacity: int) -> np.ndarray:
    """Bin number of each item, in the given order.

    ``conflicts`` are code columns (-1: none); items with equal codes in a
    column may not share a bin.
    """
    marks = _Conflicts(conflicts)
    bitmap = np.zeros((len(lengths), marks.words), np.uint64)      # by bin
    room = np.empty(len(lengths), np.int64)                        # open bins by residual
    which = np.empty(len(lengths), np.int64)
    out = np.empty(len(lengths), np.int64)
    n_open = n_bins = 0
    for i, length in enumerate(lengths):
        held = [(b // 64, np.uint64(1 << (b % 64))) for b in marks.bits[i].tolist() if b >= 0]
        at, found = int(np.searchsorted(room[:n_open], length)), -1
        while at < n_open and found < 0:
            stop = min(at + _SCAN, n_open)
            clash = np.zeros(stop - at, bool)
            for word, bit in held:
                clash |= (bitmap[which[at:stop], word] & bit) != 0
            free = int(clash.argmin())
            if not clash[free]:
                found = at + free
            at = stop
        if found >= 0:
            chosen, left = which[found], room[found] - length
        else:
            chosen, left, found = n_bins, capacity - length, n_open
            n_bins, n_open = n_bins + 1, n_open + 1
        to = int(np.searchsorted(room[:found], left))              # only residuals below move up
        room[to + 1:found + 1] = room[to:found].copy()
        which[to + 1:found + 1] = which[to:found].copy()
        room[to], which[to] = left, chosen
        for word, bit in held:
            bitmap[chosen, word] |= bit
        out[i] = chosen
    return out


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.combine_chunks().dictionary_encode().indices.fill_null(-1)).astype(np.int64)


def _pack_group(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.take(np.repeat(np.arange(len(group)), np.asarray(group["copies"])))
        group = group.sort_by([("n_words", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                               ("source", "ascending"), ("cluster", "ascending")])
        bins = best_fit(np.asarray(group["n_words"]),
                        [_codes(group[c]) for c in ("source", "cluster", "doc_id")], capacity)
        number = (group["grp"][0].as_py() << 32) + bins
        return pa.table([group["doc_id"], group["piece"], group["start"], group["n_words"], pa.array(number)],
                        names=["doc_id", "piece", "start", "n_words", "bin_id"])
    return run


@shipped
def pack(docs: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """(doc_id, piece, start, n_words, bin_id) for every document; places are in words."""
    cut = materialize(pieces(docs, capacity), "pieces")
    n_groups = max(1, -(-cut.count() // group_items))
    equal = ["doc_id", "piece", "start", "n_words", "source", "cluster"]
    bundles = cut.groupBy(*equal).count().withColumn(
        "bundle", F.explode(F.expr(f"sequence(0L, (count - 1) DIV {BUNDLE})"))).withColumn(
        "copies", F.expr(f"least(count - bundle * {BUNDLE}, {BUNDLE}L)"))
    dealt = bundles.select(*equal, "copies", F.expr(
        f"pmod(xxhash64(doc_id, piece, source, cluster, n_words, bundle), {n_groups}L)").alias("grp"))
    return dealt.groupBy("grp").applyInArrow(_pack_group(capacity), _PACKED)
