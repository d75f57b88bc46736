"""Interpolated modified Kneser-Ney bigram model, counted in Spark and read by memory map.

Tokens are words (A-Z lower-cased) and one end token per document; a begin
marker is the first word's context.  Three passes over the texts:

1. Vocabulary.  Every task counts its words (64-bit hashes) and sends sorted
   runs to hash ranges; each range is merged and stored as a sorted hash array
   with its counts.  A word's id is its place in all ranges.
2. Bigrams.  Every task looks its words up, counts pairs (context id, word id)
   and sends sorted runs to parts; each part is merged and stored as a sorted
   key array with counts.  A part is chosen by the context, and by the word
   too for frequent contexts, so no context fills a task.  Each part also sends
   partial sums per id: continuation counts of words, and how many successors
   of a context were seen once, twice or more often.
3. Scoring.  Tasks memory-map the arrays, look up the distinct words and pairs
   of 4 MB of text at a time, and sum log10 probabilities per document.

A lookup visits nearly every file of the model, however little text it is for,
and the files grow in number with the input.  So texts are gathered for it, and
each part is one file with what belongs together.

The model lives in the shared scratch folder, which must be mounted on all
workers (a ``file:`` path), as memory maps need files.  Its arrays are never
broadcast or gathered; the driver sees sums of a few numbers per part.  Files are
written under a temporary name and renamed, so a repeated task is harmless.

Defined results: null and empty texts are one end token; a null doc_id counts
as empty text for the held-out rule (so it is held out); repeated rows are
counted and scored each; with no training rows every score uses N = V = 0;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .shipping import shipped
from .textops import mix, slices, words_of

HELD_OUT_OF = 10
FLUSH = 2_000_000            # distinct entries a task holds before it sends them
UNIT_BYTES = 4 << 20         # text that is looked up together
RANGE_BYTES = 32 << 20       # text for each range of the vocabulary
PART_TOKENS = 3_000_000      # training tokens for each part of the model
MIN_PARTS = 16
SALT_UNIT = 500_000          # a context is spread over one more part for each so many tokens

_END = np.uint64(0xE4D0E4D0E4D0E4D1)
_BEGIN = np.uint64(0xFFFFFFFF)          # a context id only
_LOW = np.uint64(0xFFFFFFFF)
_RUNS = "part int, keys binary, counts binary"


def held_out(doc_ids: list) -> np.ndarray:
    return np.array([zlib.crc32(b"" if d is None else str(d).encode()) % HELD_OUT_OF == 0 for d in doc_ids], bool)


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


class _Runs:
    """Counts of one task, sent as sorted runs by part whenever there are many."""

    def __init__(self, part_of, n_parts: int):
        self.part_of, self.n_parts, self.held, self.size = part_of, n_parts, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((keys, counts.astype(np.int64)))
        self.size += len(keys)
        if self.size > 2 * FLUSH:
            self._merge()
            if self.size > FLUSH:
                yield self._send()

    def _merge(self) -> None:
        keys, counts = merged(np.concatenate([k for k, _ in self.held]), np.concatenate([c for _, c in self.held]))
        self.held, self.size = [(keys, counts)], len(keys)

    def _send(self) -> pa.RecordBatch:
        keys, counts = self.held[0]
        part = self.part_of(keys)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(self.n_parts + 1))
        rows = [(p, order[a:b]) for p, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
        self.held, self.size = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in rows], pa.int32()), pa.array([keys[r].tobytes() for _, r in rows], pa.binary()),
             pa.array([counts[r].astype(np.uint32).tobytes() for _, r in rows], pa.binary())],
            names=["part", "keys", "counts"])

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self._merge()
            yield self._send()


def _gathered(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(b"".join(group["keys"].to_pylist()), np.uint64)
    counts = np.frombuffer(b"".join(group["counts"].to_pylist()), np.uint32).astype(np.int64)
    return merged(keys, counts)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, in no order, and which of them each value is."""
    coded = pa.array(values).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy()


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``UNIT_BYTES`` of text."""
    held, size = [], 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    for batch in batches:
        for a, b in slices(batch.column("text"), UNIT_BYTES):
            held.append(batch.slice(a, b - a))
            size += held[-1].column("text").nbytes
            if size >= UNIT_BYTES:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def _save(folder: str, name: str, *arrays: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    temporary = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(temporary, "wb") as out:
        for array in arrays:
            out.write(np.ascontiguousarray(array).data)
    os.replace(temporary, f"{folder}/{name}")


@dataclass
class Model:
    """Where the arrays are, and the few numbers that belong to them."""
    folder: str
    shift: int                                   # a word's range is its hash >> shift
    offsets: np.ndarray                          # first id of each range
    n_tokens: int = 0
    n_parts: int = MIN_PARTS
    id_step: int = 1                             # ids in each file of lower-order arrays
    pair_discounts: list[float] = field(default_factory=list)
    word_discounts: list[float] = field(default_factory=list)
    n_pairs: int = 0
    word_left: float = 1.0                       # mass left to the uniform distribution

    @property
    def n_types(self) -> int:
        return int(self.offsets[-1])


class _Arrays:
    """Memory maps of a model's files, opened when first asked for."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def get(self, name: str) -> np.ndarray:
        """The bytes of a file; none if there is no such file."""
        if name not in self.open:
            if len(self.open) >= 512:
                self.open.clear()
            path = f"{self.model.folder}/{name}"
            some = os.path.exists(path) and os.path.getsize(path)
            self.open[name] = np.memmap(path, np.uint8, "r").view(np.ndarray) if some else np.zeros(0, np.uint8)
        return self.open[name]

    def counted(self, name: str, count_type: type) -> tuple[np.ndarray, np.ndarray]:
        """(ascending keys, counts) of a file of both."""
        raw = self.get(name)
        n = len(raw) // (8 + np.dtype(count_type).itemsize)
        return raw[:8 * n].view(np.uint64), raw[8 * n:].view(count_type)

    def counts_of(self, part: int) -> np.ndarray:
        """Counts of the words of a range of the vocabulary."""
        return self.counted(f"vocabulary-{part}", np.int64)[1]

    def _find(self, name: str, count_type: type, keys: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the part or -1, count) of each key."""
        order = np.argsort(keys)
        # A stable sort of numbers this short is a radix sort.
        short = part[order].astype(np.uint16 if not len(part) or part.max() < 1 << 16 else np.int64)
        by_part = np.argsort(short, kind="stable")
        order, short = order[by_part], short[by_part]
        keys = keys[order]
        edges = np.append(np.flatnonzero(np.append(True, short[1:] != short[:-1])) if len(short) else [], len(short)).astype(int)
        place, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            have, counts = self.counted(name.format(short[a]), count_type)
            if not len(have):
                continue
            at = np.searchsorted(have, keys[a:b])
            at[at == len(have)] = 0
            hit = have[at] == keys[a:b]
            place[a:b] = np.where(hit, at, -1)
            count[a:b] = np.where(hit, counts[at], 0)
        out_place, out_count = np.empty_like(place), np.empty_like(count)
        out_place[order], out_count[order] = place, count
        return out_place, out_count

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, count) of each word hash."""
        part = (hashes >> np.uint64(self.model.shift)).astype(np.int64)
        place, count = self._find("vocabulary-{}", np.int64, hashes, part)
        return np.where(place >= 0, place + self.model.offsets[part], -1), count

    def pairs(self, keys: np.ndarray, context_count: np.ndarray) -> np.ndarray:
        part = pair_part(keys, context_count, self.model.n_parts)
        return self._find("pairs-{}", np.uint32, keys, part)[1]

    def lower(self, ids: np.ndarray) -> np.ndarray:
        """(4, ids): contexts of a word, and its successors seen once, twice and more often; ids of -1 give 0."""
        out = np.zeros((4, len(ids)), np.int64)
        order = np.argsort(ids)
        order = order[np.searchsorted(ids[order], 0):]
        part = ids[order] // self.model.id_step
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
        for a, b in zip(first.tolist(), np.append(first[1:], len(part)).tolist()):
            have = self.get(f"lower-{part[a]}").view(np.int64).reshape(4, -1)
            if have.size:
                out[:, order[a:b]] = have[:, ids[order[a:b]] - part[a] * self.model.id_step]
        return out

    def begin(self) -> np.ndarray:
        """As ``lower``, of the begin marker."""
        have = self.get("lower--1").view(np.int64)
        return have if len(have) else np.zeros(4, np.int64)


def pair_part(keys: np.ndarray, context_count: np.ndarray, n_parts: int) -> np.ndarray:
    salt = np.maximum(1, -(-context_count // SALT_UNIT)).astype(np.uint64)
    spread = (keys & _LOW) % salt
    return (mix((keys >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) + spread) % np.uint64(n_parts)).astype(np.int64)


def _vocabulary_runs(shift: int, n_ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(lambda keys: (keys >> np.uint64(shift)).astype(np.int64), n_ranges)
        for batch in batches:
            train = ~held_out(batch.column("doc_id").to_pylist())
            text = batch.column("text").filter(pa.array(train))
            if not len(text):
                continue
            yield from runs.add(np.array([_END]), np.array([len(text)]))
            for a, b in slices(text):
                yield from runs.add(*np.unique(words_of(text.slice(a, b - a)).hashes(), return_counts=True))
        yield from runs.rest()
    return run


def _store_vocabulary(folder: str):
    def run(group: pa.Table) -> pa.Table:
        part = group["part"][0].as_py()
        keys, counts = _gathered(group)
        _save(folder, f"vocabulary-{part}", keys, counts)
        return pa.table({"part": pa.array([part], pa.int32()), "types": pa.array([len(keys)], pa.int64()),
                         "tokens": pa.array([int(counts.sum())], pa.int64())})
    return run


class _Tokens:
    """The tokens of some texts, the end token last in each row.

    ``which`` is each token's place among the distinct words (ids, counts), and
    ``before`` that of its context: their number for the begin marker.
    """

    def __init__(self, arrays: _Arrays, text: pa.Array):
        counts, parts = [], []
        for a, b in slices(text):
            words = words_of(text.slice(a, b - a))
            counts.append(words.counts)
            parts.append(words.hashes())
        n = np.concatenate(counts)
        self.ends = np.cumsum(n + 1) - 1
        hashes = np.full(int((n + 1).sum()), _END)
        inside = np.ones(len(hashes), bool)
        inside[self.ends] = False
        hashes[inside] = np.concatenate(parts)
        distinct, self.which = _distinct(hashes)
        self.ids, self.counts = arrays.words(distinct)
        self.before = np.append(np.int32(0), self.which[:-1])
        self.before[np.append(0, self.ends[:-1] + 1)] = len(distinct)
        end = int(self.counts[self.which[self.ends[0]]])
        self.context_ids, self.context_counts = np.append(self.ids, np.int64(_BEGIN)), np.append(self.counts, end)

    def keys(self, rows=slice(None)) -> np.ndarray:
        """(context id, word id) of the tokens ``rows``."""
        return ((self.context_ids.astype(np.uint64) << np.uint64(32))[self.before[rows]]
                | self.ids.astype(np.uint64)[self.which[rows]])


def _pair_runs(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _Arrays(model)
        end_count = int(arrays.words(np.array([_END]))[1][0])

        def training() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(~held_out(batch.column("doc_id").to_pylist()), pa.bool_()))

        def part_of(keys: np.ndarray) -> np.ndarray:
            context = (keys >> np.uint64(32)).astype(np.int64)
            distinct, which = np.unique(context, return_inverse=True)
            begin = distinct == np.int64(_BEGIN)
            part = np.searchsorted(model.offsets, distinct, side="right") - 1
            count = np.zeros(len(distinct), np.int64)
            for p in np.unique(part[~begin]):
                rows = np.flatnonzero((part == p) & ~begin)
                count[rows] = arrays.counts_of(p)[distinct[rows] - model.offsets[p]]
            count[begin] = end_count
            return pair_part(keys, count[which], model.n_parts)

        runs = _Runs(part_of, model.n_parts)
        for unit in _units(training()):
            yield from runs.add(*np.unique(_Tokens(arrays, unit.column("text")).keys(), return_counts=True))
        yield from runs.rest()
    return run


_PARTIAL = "part int, keys binary, counts binary, n1 long, n2 long, n3 long, n4 long, n long"


def _store_pairs(model: Model):
    """Store a part of the pairs; send partial sums of its words and contexts."""
    step = model.id_step

    def run(group: pa.Table) -> pa.Table:
        part = group["part"][0].as_py()
        keys, counts = _gathered(group)
        _save(model.folder, f"pairs-{part}", keys, counts.astype(np.uint32))
        context, word = (keys >> np.uint64(32)).astype(np.int64), (keys & _LOW).astype(np.int64)
        kind = np.minimum(counts, 3)                       # 0: a word's contexts; 1..3: a context's successors
        sums = [merged((word << 2).astype(np.uint64), np.ones(len(keys), np.int64)),
                merged(((context << 2) | kind).astype(np.uint64), np.ones(len(keys), np.int64))]
        keys2 = np.concatenate([k for k, _ in sums])
        counts2 = np.concatenate([c for _, c in sums])
        target = np.where((keys2 >> np.uint64(2)) == _BEGIN, -1, (keys2 >> np.uint64(2)).astype(np.int64) // step)
        order = np.argsort(target, kind="stable")
        some, first = np.unique(target[order], return_index=True)
        rows = list(zip(some.tolist(), np.split(order, first[1:])))
        tally = [int((counts == i).sum()) for i in (1, 2, 3, 4)] + [len(keys)]
        zeros = [0] * (len(rows) - 1)
        return pa.table(
            [pa.array([p for p, _ in rows], pa.int32()), pa.array([keys2[r].tobytes() for _, r in rows], pa.binary()),
             pa.array([counts2[r].astype(np.uint32).tobytes() for _, r in rows], pa.binary())]
            + [pa.array([t] + zeros, pa.int64()) for t in tally],
            names=["part", "keys", "counts", "n1", "n2", "n3", "n4", "n"])
    return run


def _store_lower(model: Model):
    """Dense arrays of a range of ids; the tally of continuation counts goes back."""
    def run(group: pa.Table) -> pa.Table:
        part = group["part"][0].as_py()
        keys, counts = _gathered(group)
        ids, kind = (keys >> np.uint64(2)).astype(np.int64), (keys & np.uint64(3)).astype(np.int64)
        first = int(_BEGIN) if part < 0 else part * model.id_step
        size = 1 if part < 0 else min(model.id_step, model.n_types - first)
        tally = np.zeros(6, np.int64)
        values = np.zeros((4, size), np.int64)           # rows as in ``_Arrays.lower``
        values[kind, ids - first] = counts
        _save(model.folder, f"lower-{part}", values)
        tally[:4] = [int((values[0] == i).sum()) for i in (1, 2, 3, 4)]
        tally[4], tally[5] = int((values[0] >= 3).sum()), int(values[0].sum())
        return pa.table([pa.array([int(x)], pa.int64()) for x in tally], names=["n1", "n2", "n3", "n4", "more", "total"])
    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts of counts 0, 1, 2 and 3 or more, from the counts of counts."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [0.0] + [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]


def _local(uri: str) -> str:
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    if "://" in uri:
        raise ValueError(f"the model's folder must be mounted on all workers, but is {uri}")
    return uri


@shipped
def train(docs: DataFrame) -> Model:
    """Count the training documents of ``docs`` (doc_id, text) and store the model."""
    spark = docs.sparkSession
    folder = _local(scratch_path(spark, f"lm-{uuid.uuid4().hex[:12]}"))
    texts = docs.select("doc_id", "text")
    # About one range for each ``RANGE_BYTES`` of text, by the rows' lengths.
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(4, int(size // RANGE_BYTES).bit_length())
    shift, n_ranges = 64 - bits, 1 << bits
    stored = {r["part"]: r for r in texts.mapInArrow(_vocabulary_runs(shift, n_ranges), _RUNS).groupBy("part")
              .applyInArrow(_store_vocabulary(folder), "part int, types long, tokens long").collect()}
    types = [stored[p]["types"] if p in stored else 0 for p in range(n_ranges)]
    model = Model(folder, shift, np.concatenate([[0], np.cumsum(types)]).astype(np.int64))
    model.n_tokens = sum(r["tokens"] for r in stored.values())
    if not model.n_tokens:
        model.pair_discounts = model.word_discounts = [0.0] * 4
        return model
    model.n_parts = max(MIN_PARTS, -(-model.n_tokens // PART_TOKENS))
    model.id_step = max(1, -(-model.n_types // model.n_parts))
    pairs = texts.mapInArrow(_pair_runs(model), _RUNS).groupBy("part").applyInArrow(_store_pairs(model), _PARTIAL)
    from ..sources.tables import materialize
    partial = materialize(pairs, "lm-partial")             # the stage that stores the pairs runs once
    n1, n2, n3, n4, model.n_pairs = partial.agg(*[F.sum(c) for c in ("n1", "n2", "n3", "n4", "n")]).first()
    model.pair_discounts = discounts(n1, n2, n3, n4)
    kinds = "n1 long, n2 long, n3 long, n4 long, more long, total long"
    w1, w2, w3, w4, more, total = (partial.select("part", "keys", "counts").groupBy("part")
                                   .applyInArrow(_store_lower(model), kinds)
                                   .agg(*[F.sum(c) for c in ("n1", "n2", "n3", "n4", "more", "total")]).first())
    model.word_discounts = discounts(w1, w2, w3, w4)
    d = model.word_discounts
    model.word_left = (d[1] * w1 + d[2] * w2 + d[3] * more) / total
    return model


def _log10_tokens(arrays: _Arrays, tokens: _Tokens) -> np.ndarray:
    """log10 of the interpolated probability of every token."""
    model = arrays.model
    lower = arrays.lower(tokens.ids)
    seen, discount = lower[0], np.array(model.word_discounts)
    p = (np.maximum(seen - discount[np.minimum(seen, 3)], 0) / max(model.n_pairs, 1)
         + model.word_left / (model.n_types + 1))[tokens.which]
    usable = np.flatnonzero(((tokens.context_ids >= 0) & (tokens.context_counts > 0))[tokens.before])
    if len(usable):
        successors = np.column_stack([lower, arrays.begin()])[1:]
        left = np.zeros(successors.shape[1])
        for values, d in zip(successors, model.pair_discounts[1:]):
            left += d * values
        before = tokens.before[usable]
        total = tokens.context_counts[before]
        known = np.flatnonzero((tokens.ids >= 0)[tokens.which[usable]])
        count = np.zeros(len(usable), np.int64)
        pairs, back = _distinct(tokens.keys(usable[known]))
        context_count = np.empty(len(pairs), np.int64)
        context_count[back] = total[known]
        count[known] = arrays.pairs(pairs, context_count)[back]
        discount = np.array(model.pair_discounts)
        p[usable] = (np.maximum(count - discount[np.minimum(count, 3)], 0) + left[before] * p[usable]) / total
    return np.log10(p)


def _score_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _Arrays(model)
        floor = np.log10(model.n_tokens + 0.1 * (model.n_types + 1))
        for unit in _units(batches):
            tokens = _Tokens(arrays, unit.column("text"))
            first = np.append(0, tokens.ends[:-1] + 1)
            n = tokens.ends - first + 1
            base = np.add.reduceat((np.log10(tokens.counts + 0.1) - floor)[tokens.which], first)
            score = np.add.reduceat(_log10_tokens(arrays, tokens), first) if model.n_tokens else base
            yield pa.RecordBatch.from_arrays(
                [unit.column("doc_id"), pa.array(held_out(unit.column("doc_id").to_pylist())), pa.array(n),
                 pa.array(np.add.reduceat((tokens.counts > 0).astype(np.int64)[tokens.which], first)),
                 pa.array(np.full(len(n), model.n_tokens)), pa.array(base), pa.array(score)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


@shipped
def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: counts, base score, model score (log10) and perplexity."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score_batches(model), "doc_id long, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double")
    return rows.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def train_and_score(docs: DataFrame) -> DataFrame:
    return score(docs, train(docs))
