"""Line dedup by a deletion-neighbourhood join over words.

A line is its words, A-Z lower-cased; lines without words are never removed.
A line is removed when an earlier line (by doc_id, then line number) is equal,
or at most one word edit (one word replaced, inserted or deleted) away when
both have ``MIN_NEAR_WORDS`` words or more.

1. Equal lines collapse to their earliest place (128-bit line hash, partial
   aggregation, so a line that fills a third of the corpus is one row).
2. An edit touches one half of a line only, so a line can have a neighbour only
   if another line has the same first or last half.  Half keys find the lines
   that need variants, and of which kind; no pair is lost.
3. Those lines emit every variant with one word deleted as a hashed key.  A
   replaced word meets under (length, position, variant), where all lines are
   neighbours of each other; an inserted word under (length, variant), where
   the longer lines are neighbours of the one whole shorter line.  So one or two
   earliest places per key answer for the whole group: no pairs inside it are made.
4. The edit distance of each line and its earliest neighbour is verified on the words.

A place names its row: different texts under one doc_id, or under none, are
told apart by a 128-bit text hash.  Ids that hold one text carry zeros instead
(a bitmap of the others is written first), so the hash costs them no bytes.

Defined results: null and empty texts have no words and lose nothing; rows
that repeat a document (same doc_id and text) have the same places and get the
same result; null doc_ids come first; different texts under one doc_id, or
under none, come in the order of their hash and are documents of their own;
empty tables give empty results; extra columns are carried and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .prefilter import bitmap, mark_likely
from .shipping import shipped
from .textops import Words, _powers, mix, slices, string_buffers, words_of

MIN_WORDS = 1
MIN_NEAR_WORDS = 8

_ROW = ("doc_id", "t1", "t2")
_PLACE = (*_ROW, "line_no")
_PLACE_TYPE = "doc_id long, t1 long, t2 long, line_no int"
_LINES = f"{_PLACE_TYPE}, n int, h1 long, h2 long, halves array<long>"
_SUB, _OWN, _DEL = 1, 2, 4


class LineHashes:
    """Lines of a word table and hashes of any word range in them."""

    def __init__(self, words: Words, offsets: np.ndarray):
        newline = np.flatnonzero(words.raw == 10)
        row = words.rows()
        order = np.searchsorted(newline, words.starts)
        at = order + row                                  # grows at each new line or row
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1]
        self.first = np.flatnonzero(new)
        self.n = np.diff(np.append(self.first, len(at)))
        self.row = row[self.first]
        self.line_no = order[self.first] - np.searchsorted(newline, offsets[self.row])
        hashes = words.hashes()
        self._power, self._inverse = _powers(len(hashes) + 1)
        self._sums = [self._cumulate(hashes), self._cumulate(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)))]

    def _cumulate(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self._power[:len(hashes)], out=out[1:])
        return out

    def of(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        """Order-sensitive hash of the words start..end (not finalised)."""
        s = self._sums[which]
        return (s[end] - s[start]) * self._inverse[start]


def _key(h: np.ndarray, length: np.ndarray, tag: int, at: np.ndarray | int = 0) -> np.ndarray:
    return mix(h + mix(np.asarray(length).astype(np.uint64) * np.uint64(8) + np.uint64(tag)
                       + (np.asarray(at).astype(np.uint64) << np.uint64(32))))


def _line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column("text")):
            text = batch.column("text").slice(a, b - a)
            words = words_of(text)
            if not len(words.starts):
                continue
            lines = LineHashes(words, string_buffers(text)[1])
            keep = lines.n >= MIN_WORDS
            s, n = lines.first[keep], lines.n[keep]
            e = s + n
            halves = np.zeros((len(s), 4), np.uint64)
            for i, m in enumerate((n, n - 1)):            # length of the shorter line of a pair
                half = m // 2
                halves[:, 2 * i] = _key(lines.of(s, s + half), m, 0)
                halves[:, 2 * i + 1] = _key(lines.of(e - (m - half), e), m, 1)
            near = n >= MIN_NEAR_WORDS
            sizes = np.where(near, 4, 0)
            flat = halves[near].reshape(-1).view(np.int64)
            edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            row = pa.array(a + lines.row[keep])
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).take(row) for c in _ROW),
                pa.array(lines.line_no[keep].astype(np.int32)), pa.array(n.astype(np.int32)),
                pa.array(_key(lines.of(s, e), n, 2).view(np.int64)),
                pa.array(_key(lines.of(s, e, 1), n, 2).view(np.int64)),
                pa.ListArray.from_arrays(pa.array(edges), pa.array(flat)),
            ], names=[*_PLACE, "n", "h1", "h2", "halves"])


def _variant_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deletion variants of single lines (place, need, line), each with its kind."""
    for batch in batches:
        for a, b in slices(batch.column("line")):
            line = batch.column("line").slice(a, b - a)
            words = words_of(line)
            n = words.counts
            first = words.first[:-1]
            if not len(words.starts):
                continue
            lines = LineHashes(words, string_buffers(line)[1])
            need = np.asarray(batch.column("need").slice(a, b - a))
            who, keys, kinds = [], [], []
            own = np.flatnonzero(need & _OWN)
            who.append(own)
            keys.append(_key(lines.of(first[own], first[own] + n[own]), n[own], 3))
            kinds.append(np.full(len(own), _OWN, np.int32))
            for flag in (_SUB, _DEL):
                some = np.flatnonzero(need & flag)
                line = np.repeat(some, n[some])
                total = np.cumsum(n[some])
                at = np.arange(len(line)) - np.repeat(total - n[some], n[some])
                s, e = first[line], first[line] + n[line]
                left = lines.of(s, s + at)
                rest = lines.of(s + at + 1, e) * lines._power[at]
                keys.append(_key(left + rest, n[line], 4, at) if flag == _SUB
                            else _key(left + rest, n[line] - 1, 3))
                who.append(line)
                kinds.append(np.full(len(line), flag, np.int32))
            take = pa.array(a + np.concatenate(who))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(kinds)),
                 *(batch.column(c).take(take) for c in _PLACE)], names=["key", "kind", *_PLACE])


def within_one_edit(x: list, y: list) -> bool:
    """At most one element replaced, inserted or deleted."""
    if abs(len(x) - len(y)) > 1:
        return False
    short = min(len(x), len(y))
    p = next((i for i in range(short) if x[i] != y[i]), short)
    q = next((i for i in range(short - p) if x[-1 - i] != y[-1 - i]), short - p)
    return max(len(x), len(y)) - p - q <= 1


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column("line").cast(pa.binary()).to_pylist()
        y = batch.column("other").cast(pa.binary()).to_pylist()
        good = [within_one_edit(a.lower().split(), b.lower().split()) for a, b in zip(x, y)]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in _PLACE], names=list(_PLACE)).filter(pa.array(good, pa.bool_()))


def _same(x: DataFrame, y: DataFrame, columns: tuple[str, ...] = _PLACE, prefix: str = ""):
    """Equal places (null ids are equal); ``y`` names its columns with ``prefix``."""
    same = F.lit(True)
    for c in columns:
        same = same & (x[c].eqNullSafe(y[prefix + c]) if c == "doc_id" else x[c] == y[prefix + c])
    return same


def _renamed(prefix: str, columns: tuple[str, ...] = _PLACE) -> list:
    return [F.col(c).alias(prefix + c) for c in columns]


def _rows(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and others) with the text hash (t1, t2), zeros where the id alone names the text."""
    t1, t2 = F.xxhash64("text"), F.xxhash64(F.lit(1), "text")
    several = (docs.where("doc_id IS NOT NULL").select("doc_id", t1.alias("t1"), t2.alias("t2")).groupBy("doc_id")
               .agg(F.min("t1").alias("a"), F.max("t1").alias("b"), F.min("t2").alias("c"), F.max("t2").alias("d"))
               .where("a < b OR c < d"))
    marked = mark_likely(docs, "doc_id", bitmap(several, "doc_id", "line-ids"), "_told")
    told = F.col("_told") | F.col("doc_id").isNull()
    return marked.withColumns({"t1": F.when(told, t1).otherwise(0), "t2": F.when(told, t2).otherwise(0)}).drop("_told")


def _near_removed(rows: DataFrame, distinct: DataFrame) -> DataFrame:
    """Places of distinct lines that have an earlier neighbour one edit away."""
    halves = distinct.where(F.size("halves") > 0).select(
        *_PLACE, "n", F.posexplode("halves").alias("at", "key")).select(
        *_PLACE, "key", (F.col("at") >= 2).alias("longer"))
    groups = halves.groupBy("key").agg(
        F.sum(F.when(F.col("longer"), 0).otherwise(1)).alias("c0"),
        F.sum(F.when(F.col("longer"), 1).otherwise(0)).alias("c1")).where("c0 >= 1 AND c0 + c1 >= 2")
    need = F.when(F.col("longer"), _DEL).otherwise(
        F.when(F.col("c0") >= 2, _SUB).otherwise(0) + F.when(F.col("c1") >= 1, _OWN).otherwise(0))
    wanted = halves.join(groups, "key").groupBy(*_PLACE).agg(F.bit_or(need.cast("int")).alias("need"))
    # A row's lines only: as many as its text has.
    per_row = wanted.groupBy(*_ROW).agg(F.collect_list(F.struct("line_no", "need")).alias("_lines"))
    source = rows.select(*_ROW, "text").where("text IS NOT NULL")
    lines = materialize(
        source.join(per_row, _same(source, per_row, _ROW)).select(
            *(source[c] for c in _ROW), F.explode("_lines").alias("l"), F.split("text", "\n", -1).alias("t"))
        .select(*_ROW, F.col("l.line_no").alias("line_no"), F.col("l.need").alias("need"),
                F.expr("coalesce(get(t, l.line_no), '')").alias("line")).dropDuplicates([*_PLACE]), "line-candidates")
    variants = lines.mapInArrow(_variant_batches, f"key long, kind int, {_PLACE_TYPE}")
    is_own, place = F.col("kind") == _OWN, F.struct(*_PLACE)
    earliest = variants.groupBy("key").agg(
        F.min(F.when(is_own, place)).alias("own"), F.min(F.when(~is_own, place)).alias("rest"),
        F.count("*").alias("n")).where("n >= 2 AND rest IS NOT NULL").drop("n")
    first = F.when(F.col("kind") == _DEL, F.col("own")).otherwise(F.col("rest"))
    pairs = (variants.join(earliest, "key").withColumn("first", first).where(F.col("first") < place)
             .groupBy(*_PLACE).agg(F.min("first").alias("first"))
             .select(*_PLACE, *(F.col(f"first.{c}").alias(f"o_{c}") for c in _PLACE)))
    own, other = lines.select(*_renamed("x_"), "line"), lines.select(*_renamed("y_"), F.col("line").alias("other"))
    both = pairs.join(own, _same(pairs, own, prefix="x_")).select(*_PLACE, *(f"o_{c}" for c in _PLACE), "line")
    wanted_other = both.select(*_PLACE, "line", *(F.col(f"o_{c}").alias(f"z_{c}") for c in _PLACE))
    joined = wanted_other.join(other, F.col("z_doc_id").eqNullSafe(F.col("y_doc_id")) & (F.col("z_t1") == F.col("y_t1"))
                               & (F.col("z_t2") == F.col("y_t2")) & (F.col("z_line_no") == F.col("y_line_no")))
    return joined.select(*_PLACE, "line", "other").mapInArrow(_verify_batches, _PLACE_TYPE).distinct()


def _removed(rows: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, removed array<int>): numbers (from 0) of removed lines, for rows that lose any."""
    lines = materialize(rows.select(*_ROW, "text").mapInArrow(_line_batches, _LINES), "lines")
    # Every row of a group has the same halves and length; max() keeps one.
    distinct = materialize(lines.groupBy("h1", "h2").agg(
        F.min(F.struct(*_PLACE)).alias("first"), F.max("n").alias("n"), F.max("halves").alias("halves"))
        .select("h1", "h2", "first.*", "n", "halves"), "lines-distinct")
    near = _near_removed(rows, distinct).select(*_renamed("x_"))
    firsts = distinct.join(near, _same(distinct, near, prefix="x_"), "left").select(
        "h1", "h2", *_renamed("f_"), F.col("x_line_no").isNotNull().alias("near"))
    gone = lines.join(firsts, ["h1", "h2"])
    first = (F.col("doc_id").eqNullSafe(F.col("f_doc_id")) & (F.col("t1") == F.col("f_t1"))
             & (F.col("t2") == F.col("f_t2")) & (F.col("line_no") == F.col("f_line_no")))
    return gone.where(~first | F.col("near")).groupBy(*_ROW).agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


@shipped
def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, removed (line numbers from 0, comma-joined)."""
    rows = _rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    gone = _removed(rows).select(*_renamed("g_", _ROW), "removed")
    counted = rows.select(*_ROW, F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"))
    return counted.join(gone, _same(counted, gone, _ROW, "g_"), "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed"))


@shipped
def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without removed lines; a document that had words and keeps none goes.

    ``n_chars`` follows the new text when the column is there.
    """
    held = _rows(docs.select(F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("_row"),
                             docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")))
    gone = _removed(held).select(*_renamed("g_", _ROW), F.col("removed").alias("_g_removed"))
    joined = held.join(gone, _same(held, gone, _ROW, "g_"), "left")
    text = F.expr(r"""IF(_g_removed IS NULL, text, array_join(filter(split(text, '\n', -1),
        (l, i) -> NOT array_contains(_g_removed, i)), '\n'))""")
    kept = joined.withColumn("_new", text).where(r"_g_removed IS NULL OR _new RLIKE '[^\\x20\\x09-\\x0D]'")
    out = []
    for i, c in enumerate(docs.columns):
        value = F.col(f"_row.c{i}")
        if c == "text":
            value = F.col("_new")
        elif c == "n_chars":
            value = F.when(F.col("_g_removed").isNull(), value).otherwise(
                F.length("_new").cast(docs.schema[c].dataType))
        out.append(value.alias(c))
    return kept.select(*out)
