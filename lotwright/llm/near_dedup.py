"""Near-duplicate documents by banded minima and bottom-k sketches.

A document's set is its distinct word shingles (A-Z lower-cased), each one
64-bit hash.  Its sketch is the ``K`` smallest hashes; a set of up to ``K``
is kept whole.  Its bands are hashes of four minima each (six, if the set is
kept whole), every minimum in an order of its own.

1. Documents with equal sets collapse to one node (128-bit set hash).
2. Inverted lists of the bands.  Two sets of similarity J have the same value
   in a band of r minima with probability J ** r; there are so many bands that
   a pair at the limit meets in fewer than ``MEETINGS`` with probability
   ``MISSED``.  A single shingle makes no list, however many documents hold it,
   so lists of unlike documents stay short while the corpus grows, and a node
   is in as many lists as it has bands.
3. Lists of up to ``COLD`` nodes give pairs; those that meet often enough are
   filtered by the estimate
   from the union's sketch (two sets at the limit share at least ``MIN_OVERLAP``
   of its ``K`` values, probability of fewer below 1e-10; two sets kept whole
   are compared exactly), and exact Jaccard on the full sets verifies the rest.
4. Longer lists are never expanded into pairs.  The nodes they connect form
   families (large groups of near copies), cut into blocks of bounded size;
   each pair of blocks is one task that computes all its exact intersections as
   a matrix product and returns a spanning forest of the links.  So large
   groups lose no link and give few rows.
5. Components of the links; a document's component is the smallest doc_id in it.

Defined results: null and empty texts have an empty set and are linked with
nothing; a text with fewer words than a shingle has one shingle; repeated rows
share a component; a null doc_id has no order and gets the smallest id of its
component, or null; different texts under one doc_id, or under none, are told
apart by a 128-bit text hash; empty tables give empty results; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import tables
from .colocated import shuffles_end_with_the_write
from .components import components
from .prefilter import likely_in
from .shipping import shipped
from .textops import Words, chain, mix, slices, words_of

K = 64
MIN_OVERLAP = 26
#: Two sets at the limit meet in this many lists, but with probability ``MISSED``.
MEETINGS, MISSED = 2, 1e-11
#: Minima in a band of sets kept whole, which share common shingles more often, and of others; fewer if the limit
#: is so low that there would be more than ``MAX_BANDS``.
BAND_ROWS, MAX_BANDS = (6, 4), 256
COLD = 32
BLOCK_ROWS = 800
BLOCK_VALUES = 1 << 20
_STEP = np.uint64(0xD6E8FEB86659FD93)        # odd, as in ``chain``

#: Text bytes worked on at once: small enough that the working arrays stay in the cache.
SKETCH_BYTES = 1 << 18

_SKETCH = "n_words long, n long, k1 long, k2 long, sketch binary, bands binary"
#: What names a row: its id and the hash of its text.
_ROW = ("doc_id", "t1", "t2")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``tables.materialize``; the shuffle files go when the table is written."""
    with shuffles_end_with_the_write(df.sparkSession):
        return tables.materialize(df, name)


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, first): each row's distinct shingle hashes, ascending, and where they begin."""
    h, count = words.hashes(), words.counts
    row = words.rows()
    n = len(h) - size + 1
    if n > 0:
        values = h[:n].copy()
        for i in range(1, size):
            values *= _STEP
            values += h[i:i + n]
        whole = row[:n] == row[size - 1:]
        values, at = mix(values[whole]), row[:n][whole]
    else:
        values, at = h[:0], row[:0]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = []
        for r in short:
            v = h[words.first[r]:words.first[r] + 1]
            for i in range(1, count[r]):
                v = chain(v, h[words.first[r] + i:words.first[r] + i + 1])
            extra.append(mix(v + np.uint64(1)))
        values, at = np.concatenate([values, *extra]), np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        values, at = values[order], at[order]
    first = np.searchsorted(at, np.arange(len(count) + 1))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (at[1:] != at[:-1])
    kept = np.zeros(len(values) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return values[keep], kept[first]


def _set_keys(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit hashes of each set."""
    n = np.diff(first).astype(np.uint64)
    keys = []
    for salt in (0x51ED270B, 0x2545F4914F6CDD1D):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values ^ np.uint64(salt)), out=total[1:])
        keys.append(mix(total[first[1:]] - total[first[:-1]] + n).view(np.int64))
    return keys[0], keys[1]


def bands_for(percent: int, rows: int) -> tuple[int, int]:
    """(bands, minima in a band): ``rows`` minima at most."""
    for r in range(rows, 0, -1):
        met = (percent / 100) ** r
        bands = next((b for b in range(MEETINGS, MAX_BANDS + 1) if (1 - met) ** b + b * met * (1 - met) ** (b - 1) <= MISSED), None)
        if bands:
            return bands, r
    raise ValueError(f"no bands for a limit of {percent} %")


def _minima(values: np.ndarray, first: np.ndarray, bands: int, rows: int, salt: int) -> np.ndarray:
    """(sets, bands): hashes of the minima of sets that are not empty."""
    low = values.astype(np.uint32)                          # the sketch orders by the high bits
    factors = (mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * _STEP) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    out, work = np.zeros((len(first) - 1, bands), np.uint64), np.empty_like(low)
    for band in range(bands):
        key = np.full(len(out), salt * MAX_BANDS + band, np.uint64)
        for factor in factors[band * rows:(band + 1) * rows]:
            key = chain(key, np.minimum.reduceat(np.multiply(low, factor, out=work), first[:-1]).astype(np.uint64))
        out[:, band] = key
    return out


def set_bands(values: np.ndarray, first: np.ndarray, percent: int) -> list[bytes]:
    """The bands of each set: those of sets kept whole if a partner at the limit may be one, and the same for others.

    A set so small that no other reaches the limit with it has none.
    """
    n = np.diff(first)
    pairs = (n > 0) & (n * (100 - percent) >= percent)
    out = [b""] * len(n)
    for salt, (rows, some) in enumerate(zip(BAND_ROWS, (pairs & (percent * n <= 100 * K), pairs & (n > K)))):
        at = np.flatnonzero(some)
        if len(at):
            own = _minima(values[np.repeat(some, n)], np.append(0, np.cumsum(n[at])), *bands_for(percent, rows), salt)
            for i, x in zip(at.tolist(), own):
                out[i] += x.tobytes()
    return out


def _sketch_batches(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.drop_columns(["text"])
            for a, b in slices(batch.column("text"), SKETCH_BYTES):
                words = words_of(batch.column("text").slice(a, b - a))
                values, first = shingle_sets(words, size)
                k1, k2 = _set_keys(values, first)
                sketch = [values[s:min(e, s + K)].tobytes() for s, e in zip(first[:-1].tolist(), first[1:].tolist())]
                bands = set_bands(values, first, percent)
                yield pa.RecordBatch.from_arrays(
                    [*own.slice(a, b - a).columns, pa.array(words.counts), pa.array(np.diff(first)), pa.array(k1),
                     pa.array(k2), pa.array(sketch, pa.binary()), pa.array(bands, pa.binary())],
                    names=[*own.schema.names, "n_words", "n", "k1", "k2", "sketch", "bands"])
    return run


def _set_batches(size: int):
    """Full sets of documents (node, text); a row whose set is another node's goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text"), SKETCH_BYTES):
                values, first = shingle_sets(words_of(batch.column("text").slice(a, b - a)), size)
                k1, _ = _set_keys(values, first)
                node = np.asarray(batch.column("node").slice(a, b - a))
                sets = [values[s:e].tobytes() for s, e in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(sets, pa.binary())],
                                                 names=["node", "shingles"]).filter(pa.array(node == k1))
    return run


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, node, n) of every band of rows (node, n, bands)."""
    for batch in batches:
        bands = batch.column("bands").to_pylist()
        size = np.array([len(b) // 8 for b in bands], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.frombuffer(b"".join(bands), np.int64)), pa.array(np.repeat(np.asarray(batch.column("node")), size)),
             pa.array(np.repeat(np.asarray(batch.column("n")), size))], names=["value", "node", "n"])


def _met(u: np.ndarray, v: np.ndarray, cold: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), pa.array(np.full(len(u), cold))],
                                      names=["u", "v", "cold"])


def _list_batches(percent: int, most: int):
    """(u, v, cold) of rows (value, node, n) in order of ``value`` and ``node``; repeated rows count once.

    A list of up to ``most`` nodes gives its pairs whose sizes allow the limit
    (cold); a longer one links each node to its first, a batch at a time.
    """
    def pairs(value: np.ndarray, node: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
        length = np.diff(np.append(first, len(value)))
        head, size = np.repeat(first, length), np.repeat(length, length)
        far = (size > most) & (head < np.arange(len(value)))
        yield _met(node[head[far]], node[far], False)
        rows = np.flatnonzero((size > 1) & (size <= most))
        for step in range(1, most):
            rows = rows[rows + step < head[rows] + size[rows]]
            if not len(rows):
                break
            low, high = np.minimum(n[rows], n[rows + step]), np.maximum(n[rows], n[rows + step])
            near = rows[100 * low >= percent * high]
            yield _met(node[near], node[near + step], True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pivot = [np.zeros(0, np.int64)] * 3, None    # rows of the last list; or its first node, if it is long
        open_value = None
        for batch in batches:
            value, node, n = (np.concatenate([h, np.asarray(batch.column(c))]) for h, c in zip(held, ("value", "node", "n")))
            if pivot is not None:
                cut = int(np.searchsorted(value, open_value, side="right"))
                yield _met(np.full(cut, pivot), node[:cut], False)
                value, node, n = value[cut:], node[cut:], n[cut:]
                pivot = None if len(value) else pivot
            new = np.ones(len(value), bool)
            new[1:] = (value[1:] != value[:-1]) | (node[1:] != node[:-1])
            value, node, n = value[new], node[new], n[new]
            last = int(np.searchsorted(value, value[-1])) if len(value) else 0
            yield from pairs(value[:last], node[:last], n[:last])
            held = [value[last:], node[last:], n[last:]]
            if len(value) - last > most:
                pivot, open_value = node[last], value[last]
                yield _met(np.full(len(value) - last - 1, pivot), node[last + 1:], False)
                held = [x[:0] for x in held]
        yield from pairs(*held)
    return run


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two ascending arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def estimate_passes(x: np.ndarray, y: np.ndarray, n_x: int, n_y: int, percent: int) -> bool:
    """Whether two sketches may belong to sets at or above the limit.

    The K smallest values of the union of the sketches are a sketch of the
    union; the share of them in both estimates the similarity.
    """
    union = np.union1d(x, y)
    if n_x <= K and n_y <= K:                     # both sets are whole: exact
        return 100 * _common(x, y) >= percent * len(union)
    union = union[:K]
    both = np.isin(union, x) & np.isin(union, y)
    return int(both.sum()) * K >= MIN_OVERLAP * len(union)


def _estimate_batches(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("sketch_u", "sketch_v", "n_u", "n_v")])
            good = [estimate_passes(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), n, m, percent)
                    for x, y, n, m in rows]
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")],
                                             names=["u", "v"]).filter(pa.array(good, pa.bool_()))
    return run


def _exact_batches(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("set_u").to_pylist(), batch.column("set_v").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = _common(x, y)
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")],
                                             names=["u", "v"]).filter(pa.array(good, pa.bool_()))
    return run


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, as matrix products over slices of the values."""
    m = len(sets)
    value = np.concatenate(sets)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(value, kind="stable")
    value, row = value[order], row[order]
    column = np.cumsum(np.append(True, value[1:] != value[:-1])) - 1
    shared = np.bincount(column)[column] > 1
    row, column = row[shared], column[shared]
    out = np.zeros((m, m), np.float32)
    if len(column):
        column = np.cumsum(np.append(True, column[1:] != column[:-1])) - 1
        for low in range(0, int(column[-1]) + 1, 4096):
            a, b = np.searchsorted(column, [low, low + 4096])
            cells = np.zeros((m, 4096), np.float32)
            cells[row[a:b], column[a:b] - low] = 1
            out += cells @ cells.T
    return out


def _family_links(percent: int):
    def run(group: pa.Table) -> pa.Table:
        nodes = np.asarray(group["node"])
        order = np.argsort(nodes)
        nodes = nodes[order]
        raw = group["shingles"].to_pylist()
        sets = [np.frombuffer(raw[i], np.uint64) for i in order]
        both = _intersections(sets)
        size = np.array([len(s) for s in sets], np.float64)
        linked = 100 * both.astype(np.float64) >= percent * (size[:, None] + size[None, :] - both)
        root = np.full(len(nodes), -1)
        for r in range(len(nodes)):
            if root[r] < 0:
                root[r], reach = r, linked[r] & (root < 0)
                while reach.any():
                    root[reach] = r
                    reach = linked[reach].any(axis=0) & (root < 0)
        far = root != np.arange(len(nodes))
        return pa.table([pa.array(nodes[far]), pa.array(nodes[root[far]])], names=["u", "v"])
    return run


def _rows(docs: DataFrame, *columns) -> DataFrame:
    """(doc_id, t1, t2, text) and other columns of ``docs``."""
    text = docs["text"]
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("t1"),
                       F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text"), *columns)


def _same_row(x: DataFrame, y: DataFrame):
    return x["doc_id"].eqNullSafe(y["doc_id"]) & (x["t1"] == y["t1"]) & (x["t2"] == y["t2"])


def links(docs: DataFrame, sketched: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v): links between nodes whose components are those of all links."""
    bands = sketched.where("n > 0").select(F.col("k1").alias("node"), "n", "bands").mapInArrow(
        _band_batches, "value long, node long, n long")
    met = materialize(bands.repartition("value").sortWithinPartitions("value", "node")
                      .mapInArrow(_list_batches(percent, COLD), "u long, v long, cold boolean"), "near-met")

    families = components(met.where("NOT cold").select("u", "v"), "near-families")
    families = materialize(families.select("node", F.col("root").alias("family")), "near-family")

    # Nodes of different families share no longer list, so all their meetings count here.
    pairs = (met.where("cold").groupBy("u", "v").agg(F.count("*").alias("met"))
             .where(F.col("met") >= MEETINGS).select("u", "v"))
    f_u = families.select(F.col("node").alias("u"), F.col("family").alias("f_u"))
    f_v = families.select(F.col("node").alias("v"), F.col("family").alias("f_v"))
    pairs = materialize(pairs.join(f_u, "u", "left").join(f_v, "v", "left")
                        .where("f_u IS NULL OR f_v IS NULL OR f_u <> f_v").select("u", "v"), "near-pairs")
    paired = pairs.select(F.col("u").alias("key")).union(pairs.select("v"))
    sketches = (likely_in(sketched.select("k1", "n", "sketch"), "k1", paired, "key", "near-bits")
                .groupBy(F.col("k1").alias("node")).agg(F.max("n").alias("n"), F.max("sketch").alias("sketch")))
    for side in ("u", "v"):
        pairs = pairs.join(sketches.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"),
                                           F.col("sketch").alias(f"sketch_{side}")), side)
    likely = materialize(pairs.select("u", "v", "n_u", "n_v", "sketch_u", "sketch_v")
                         .mapInArrow(_estimate_batches(percent), "u long, v long"), "near-likely")

    needed = (likely.select(F.col("u").alias("node")).union(likely.select("v")).union(families.select("node"))
              .distinct().join(nodes.select("node", "rep.*"), "node"))
    wanted = materialize(needed, "near-wanted")
    row = F.xxhash64(*_ROW).alias("row")
    source = likely_in(_rows(docs).select("*", row), "row", wanted.select(row), "row", "near-bits")
    sets = materialize(source.join(wanted, _same_row(source, wanted)).select("node", "text")
                       .mapInArrow(_set_batches(size), "node long, shingles binary").dropDuplicates(["node"]), "near-sets")
    exact = likely
    for side in ("u", "v"):
        exact = exact.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    found = exact.select("u", "v", "set_u", "set_v").mapInArrow(_exact_batches(percent), "u long, v long")

    grouped = families.join(nodes.select("node", "n"), "node")
    blocks = grouped.groupBy("family").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_VALUES)).cast("int").alias("n_blocks"))
    dealt = (families.join(blocks, "family").join(sets, "node")
             .withColumn("own", F.expr("CAST(pmod(xxhash64(node), n_blocks) AS INT)"))
             .withColumn("mate", F.explode(F.expr("sequence(0, n_blocks - 1)"))))
    within = dealt.select("family", F.least("own", "mate").alias("x"), F.greatest("own", "mate").alias("y"),
                          "node", "shingles").groupBy("family", "x", "y").applyInArrow(
        _family_links(percent), "u long, v long")
    return found.union(within)


def _graph(docs: DataFrame, size: int, percent: int, *held) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of the rows, nodes (node, rep, n), and (node, root) of the linked ones.

    ``rep`` is the node's first row: smallest doc_id (null last), then text hash.
    The sketches carry the columns ``held`` of ``docs``.
    """
    rows = _rows(docs, *held)
    schema = StructType([*rows.drop("text").schema, *StructType.fromDDL(_SKETCH)])
    sketched = materialize(rows.mapInArrow(_sketch_batches(size, percent), schema), "near-sketch")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *_ROW)).alias("rep")
    nodes = materialize(sketched.where("n > 0").groupBy("k1", "k2").agg(
        first, F.max("n").alias("n"))
        .withColumnRenamed("k1", "node").drop("k2"), "near-nodes")
    return sketched, nodes, components(links(docs, sketched, nodes, size, percent), "near-components")


def _labels(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, component_id) of every node."""
    ids = nodes.select("node", F.col("rep.doc_id").alias("low"))
    rooted = ids.join(roots, "node")
    label = rooted.groupBy("root").agg(F.min("low").alias("label"))
    return materialize(ids.join(rooted.join(label, "root").select("node", "label"), "node", "left")
                       .select("node", F.coalesce("label", "low").alias("component_id")), "near-labels")


@shipped
def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document.

    ``size`` words make a shingle; documents link when
    100 * intersection >= ``percent`` * union.
    """
    sketched, nodes, roots = _graph(docs, size, percent)
    labels = _labels(nodes, roots)
    full = sketched.select("doc_id", "n", "k1").where("n > 0").join(labels, F.col("k1") == F.col("node"))
    empty = sketched.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "n", "component_id").union(empty).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@shipped
def with_components(docs: DataFrame, held: str, size: int = 5, percent: int = 80) -> DataFrame:
    """(held, n_words, component_id) for every document: its column ``held``, its words, its component.

    Components are those of ``near_duplicates``; a document without words has none.
    The text is read once for both.
    """
    sketched, nodes, roots = _graph(docs, size, percent, docs[held].alias("held"))
    labels = _labels(nodes, roots)
    full = sketched.where("n > 0").join(labels, F.col("k1") == F.col("node"))
    empty = sketched.where("n = 0").withColumn("component_id", F.lit(None).cast("long"))
    columns = [F.col("held").alias(held), "n_words", "component_id"]
    return full.select(*columns).union(empty.select(*columns))


@shipped
def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, with its columns.

    The group's first row stays: smallest doc_id (null last), then text hash.
    Documents without words are in no group and stay; of rows that repeat a
    document (same doc_id and text), one.
    """
    sketched, nodes, roots = _graph(docs, size, percent)
    linked = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = (linked.groupBy("root").agg(F.min("rep").alias("rep")).select("rep.*").drop("no_id")
            .union(sketched.where("n = 0").select(*_ROW).distinct()))
    kept = materialize(kept, "near-kept")
    names = [f"c{i}" for i in range(len(docs.columns))]
    held = _rows(docs, F.struct(*[docs[c].alias(n) for c, n in zip(docs.columns, names)]).alias("_row")).drop("text")
    rows = held.join(kept, _same_row(held, kept), "left_semi").dropDuplicates([*_ROW])
    return rows.select(*[F.col(f"_row.{n}").alias(c) for c, n in zip(docs.columns, names)])
