"""Subword encoding with seeded merge-dropout, and lossless decoding.

A text gets the vocabulary's dummy prefix and its spaces become the space
mark.  No piece goes from a character to a following space mark or from a
letter to a full stop or comma, and none holds a line end (this is checked when
the vocabulary is read), so the text falls into chunks that are encoded on
their own.  In a chunk an agenda holds the adjacent pairs
that form a piece, best score first, then leftmost.  Each popped candidate is
skipped for good when a keyed hash of (seed, variant, doc_id, the chunk's place
in the text, place of the pair) falls below the dropout rate, so the same seed
always gives the same pieces, on any machine and in any order, and every
occurrence of a word draws for itself.  A document's variant is a keyed hash
of its doc_id.  With a rate of 0 the result is the library's own segmentation.

What a worker caches are outcomes: a chunk with the candidates dropped from it.
New outcomes of a slice of texts run their agendas side by side in numpy: each
round takes every chunk's best candidate.  Long chunks, and chunks with
characters outside the vocabulary, use a heap; both give the same pieces.

Characters outside the vocabulary become byte pieces, and so does the space
mark itself where a text holds it: decoding gives back every text exactly.

Defined results: null and empty texts have no pieces (decoded: empty); a null
doc_id is variant 0 and draws by its text; repeated rows are encoded each, alike; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import shipped
from .textops import slices

MARK = "▁"
RATE = 0.1
VARIANTS = 4
#: A worker forgets its cached outcomes beyond this number (memory, not results).
CACHE_OUTCOMES = 500_000
CACHE_CHUNK_CHARS = 32

_CHUNK = re.compile(f" *[A-Za-zÀ-ɏ]++(?=[.,])| *[^ \n{MARK}]+| *[\n{MARK}]| +")
_EDGE = re.compile(f"[^{MARK}]{MARK}|[A-Za-zÀ-ɏ][.,]|\n")      # what no piece may hold
_LITERAL = "\x00" + MARK          # a space mark of the text itself; no piece
NO_MERGE = np.iinfo(np.int32).max
_WORKER: dict[tuple, "Encoder"] = {}


class Vocabulary:
    """Pieces, merge ranks and bytes of a model file."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                                              or model.is_unused(i))]
        self.ids = {pieces[i]: i for i in normal}
        by_score = sorted(normal, key=lambda i: (-model.get_score(i), i))
        rank, last = -1, None
        self.rank: dict[str, int] = {}
        for i in by_score:
            if model.get_score(i) != last:
                rank, last = rank + 1, model.get_score(i)
            self.rank[pieces[i]] = rank
        if any(_EDGE.search(p) for p in self.ids):
            raise ValueError("pieces of this vocabulary cross chunk edges")
        # Merges by ids: every way to put a piece together from two pieces.
        merges = {(self.ids[p[:i]], self.ids[p[i:]]): (n_id, self.rank[p]) for p, n_id in self.ids.items()
                  for i in range(1, len(p)) if p[:i] in self.ids and p[i:] in self.ids}
        pairs = np.array([a * n + b for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.n_pieces, self.pairs = n, pairs[order]
        self.merged, self.merge_rank = (np.array(x, np.int32)[order] for x in zip(*merges.values()))
        self._fill_slots()
        self.byte_ids = {int(pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.raw = [b""] * n
        for p, i in self.ids.items():
            self.raw[i] = p.replace(MARK, " ").encode()
        for b, i in self.byte_ids.items():
            self.raw[i] = bytes([b])

        self.sizes = np.array([len(r) for r in self.raw], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.table = np.frombuffer(b"".join(self.raw), np.uint8)

    def merges(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(merged id, rank) of pairs of ids; the rank is NO_MERGE where there is none."""
        key = left.astype(np.int64) * self.n_pieces + right
        slot = self._slot(key)
        at = self.slots[slot]
        rank = np.full(len(key), NO_MERGE, np.int32)
        look = np.flatnonzero((at >= 0) & (left >= 0) & (right >= 0))
        while len(look):
            here = at[look]
            good = self.pairs[here] == key[look]
            rank[look[good]] = self.merge_rank[here[good]]
            look = look[~good]
            slot[look] = (slot[look] + 1) & self.slot_mask
            at[look] = self.slots[slot[look]]
            look = look[at[look] >= 0]
        return self.merged[at], rank

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & self.slot_mask

    def _fill_slots(self) -> None:
        """Hash table of the pairs, linear probing: numbers of pairs, -1 where a slot is free."""
        self.slot_mask = (1 << min(24, max(4, (8 * len(self.pairs)).bit_length()))) - 1
        self.slots = np.full(self.slot_mask + 1, -1, np.int32)
        left, slot = np.arange(len(self.pairs), dtype=np.int32), self._slot(self.pairs)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]              # of several, the last one stays
            go_on = self.slots[slot] != left
            left, slot = left[go_on], (slot[go_on] + 1) & self.slot_mask

    def decode(self, ids: list[int]) -> str:
        """The text of a piece sequence, without the dummy prefix."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]

    def decode_all(self, ids: np.ndarray, edges: np.ndarray) -> list[bytes]:
        """UTF-8 texts of many sequences, ids[edges[i]:edges[i + 1]] each."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        data = self.table[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[ids] - ends + sizes, sizes)]
        at = np.concatenate([[0], ends])[edges]
        whole = data.tobytes()
        return [whole[a + 1:b] for a, b in zip(at[:-1], at[1:])]


def _draw(key: int, candidate: int) -> int:
    """32 bits of a candidate's keyed hash; ``_draws`` is the same for arrays."""
    h = key ^ candidate
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return h >> 32


def _draws(key: np.ndarray, candidate: np.ndarray) -> np.ndarray:
    h = key ^ candidate.astype(np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h >> np.uint64(32)


def _place_keys(doc_key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Keys of the occurrences at the places of texts."""
    h = doc_key + (place + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Rows:
    """Rows of numbers of different lengths, one after another in one growing array."""

    def __init__(self, kind):
        self.values, self.first, self.size, self.n, self.used = np.zeros(1024, kind), np.zeros(1024, np.int64), np.zeros(1024, np.int64), 0, 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while self.n + len(sizes) > len(self.first):
            self.first, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.size))
        self.values[self.used:self.used + len(values)] = values
        self.first[self.n:self.n + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.size[self.n:self.n + len(sizes)] = sizes
        self.n, self.used = self.n + len(sizes), self.used + len(values)

    def cut(self, n: int) -> None:
        """Forget the rows from the n-th on."""
        if n < self.n:
            self.n, self.used = n, int(self.first[n])

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of the rows one after another, where each row ends)."""
        size = self.size[rows]
        ends = np.cumsum(size)
        return self.values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.first[rows] - ends + size, size)], ends


class Encoder:
    """Keyed agenda encoder of one (seed, rate), with a cache of agendas.

    An outcome is a chunk with the candidates that were dropped from it: its
    pieces and the candidates merged on the way follow from these alone.  Each
    occurrence draws for its own candidates and goes from the outcome without
    drops to the one with its first drop, and so on until it drops no more.
    """

    def __init__(self, vocabulary: Vocabulary, seed: int, rate: float):
        self.vocabulary, self.seed = vocabulary, seed
        self.below = int(rate * (1 << 32))
        self._forget()

    def _forget(self) -> None:
        self.whole: dict[str, int] = {}                 # outcome without drops; -1: by the heap
        self.after: dict[int, int] = {}                 # outcome * 64 + dropped candidate's number: outcome
        self.chunk: list[str] = []                      # by outcome, as the next three
        self.drops: list[tuple[int, ...]] = []
        self.ids, self.merged = _Rows(np.int32), _Rows(np.int64)

    def _key(self, variant: int, chunk: str) -> int:
        return xxhash.xxh3_64_intdigest(chunk.encode(), seed=self.seed * 1_000_003 + variant)

    def pieces(self, chunk: str, variant: int, key: int | None = None) -> list[str]:
        """Agenda processing of one chunk; ``key`` is its occurrence's."""
        rank = self.vocabulary.rank
        symbols: list[str | None] = list(chunk)
        if " " in chunk or MARK in chunk:
            symbols = [MARK if c == " " else _LITERAL if c == MARK else c for c in chunk]
        n = len(symbols)
        if n == 1:
            return symbols
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = map(str.__add__, symbols, symbols[1:])
        agenda = [(rank[p], i, p) for i, p in enumerate(pairs) if p in rank]
        heapq.heapify(agenda)
        below = self.below
        if key is None:
            key = self._key(variant, chunk)
        while agenda:
            _, i, piece = heapq.heappop(agenda)
            left, j = symbols[i], following[i]
            if left is None or j >= n or len(left) >= len(piece) or left + symbols[j] != piece:
                continue
            if below:
                if _draw(key, i << 42 | j << 21 | len(piece)) < below:
                    continue
            symbols[i], symbols[j] = piece, None
            following[i] = k = following[j]
            if k < n:
                before[k] = i
                new = piece + symbols[k]
                r = rank.get(new)
                if r is not None:
                    heapq.heappush(agenda, (r, i, new))
            p = before[i]
            if p >= 0:
                new = symbols[p] + piece
                r = rank.get(new)
                if r is not None:
                    heapq.heappush(agenda, (r, p, new))
        return [s for s in symbols if s is not None]

    def _ids(self, chunk: str, variant: int, key: int) -> np.ndarray:
        v, out = self.vocabulary, []
        for s in self.pieces(chunk, variant, key):
            i = v.ids.get(s)
            if i is not None:
                out.append(i)
            else:
                out += [v.byte_ids[b] for b in (MARK if s == _LITERAL else s).encode()]
        return np.array(out, np.int32)

    def _side_by_side(self, chunks: list[str], drops: list[tuple[int, ...]]) -> tuple[np.ndarray, ...]:
        """Agendas of short chunks in numpy, each without the candidates in its ``drops``.

        (ids, their number by chunk, merged candidates, their number by chunk,
        whether a chunk has unknown characters).
        """
        v = self.vocabulary
        size = np.array([len(c) for c in chunks])
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4")
        letters, which = np.unique(codes, return_inverse=True)
        ids = np.array([v.ids.get(MARK if x == 32 else "" if chr(x) == MARK else chr(x), -2) for x in letters.tolist()], np.int64)
        n, width = len(chunks), int(size.max())
        wide = width + 2                     # a column before the first symbol, and one for the end
        inside = np.arange(width) < size[:, None]
        symbol = np.full((n, wide), -1, np.int32)
        symbol[:, 1:width + 1][inside] = ids[which]
        unknown = (symbol == -2).any(axis=1)
        # A symbol stays in the column of its first character; ``after`` and ``before`` lead to its neighbours.
        before = np.tile(np.arange(-1, width + 1, dtype=np.int32), (n, 1)).ravel()
        after = np.tile(np.arange(1, width + 3, dtype=np.int32), (n, 1)).ravel()
        rank, piece = np.full((n, wide), NO_MERGE, np.int32), np.zeros((n, wide), np.int32)
        # Characters are few: their pairs are looked up once each.
        pair_piece, pair_rank = (x.reshape(len(ids), -1) for x in v.merges(np.repeat(ids, len(ids)), np.tile(ids, len(ids)))) \
            if len(ids) * len(ids) < 4 * len(which) else (None, None)
        pairs = inside[:, 1:]                # whether the column's character has one after it
        first = np.cumsum(size) - size
        last = np.ones(len(which), bool)
        last[first + size - 1] = False
        left = np.flatnonzero(last)
        if pair_rank is None:
            piece[:, 1:width][pairs], rank[:, 1:width][pairs] = v.merges(ids[which[left]], ids[which[left + 1]])
        else:
            piece[:, 1:width][pairs] = pair_piece[which[left], which[left + 1]]
            rank[:, 1:width][pairs] = pair_rank[which[left], which[left + 1]]
        n_drops = np.fromiter(map(len, drops), np.int64, n)
        dropped = np.full((n, int(n_drops.max())), -1, np.int64)
        dropped[np.arange(dropped.shape[1]) < n_drops[:, None]] = list(chain.from_iterable(drops))
        merged, n_merged = np.zeros((n, width), np.int64), np.zeros(n, np.int64)
        flat_symbol, flat_piece = symbol.ravel(), piece.ravel()
        live, open_ = np.arange(n), rank               # ``open_`` holds the ranks of the live rows
        while len(live):
            best = open_.argmin(axis=1)
            value = open_[np.arange(len(live)), best]
            if (some := value < NO_MERGE).sum() < len(live):
                live, best, open_ = live[some], best[some], open_[some]
                if not len(live):
                    break
            at = live * wide + best
            right = after[at].astype(np.int64)
            end = after[live * wide + right].astype(np.int64)
            if dropped.shape[1]:
                candidate = (best - 1) << 42 | (right - 1) << 21 | (end - best)
                skip = (dropped[live] == candidate[:, None]).any(axis=1)
                open_[skip, best[skip]] = NO_MERGE
                row = np.flatnonzero(~skip)
                at, best, right, end, candidate = at[row], best[row], right[row], end[row], candidate[row]
            else:
                candidate, row = (best - 1) << 42 | (right - 1) << 21 | (end - best), np.arange(len(live))
            rows = live[row]
            merged[rows, n_merged[rows]] = candidate
            n_merged[rows] += 1
            base = rows * wide
            flat_symbol[at] = flat_piece[at]
            flat_symbol[base + right] = -1
            open_[row, right] = NO_MERGE
            after[at] = end
            before[base + end] = best
            prior = before[at].astype(np.int64)
            # The pairs with the symbol before (none in column 0: -1 there) and after.
            new_piece, new_rank = v.merges(flat_symbol[np.concatenate([base + prior, at])], flat_symbol[np.concatenate([at, base + end])])
            m = len(row)
            flat_piece[base + prior], open_[row, prior] = new_piece[:m], new_rank[:m]
            flat_piece[at], open_[row, best] = new_piece[m:], new_rank[m:]
        symbol = symbol[:, 1:width + 1]
        column = np.arange(width)
        kept = (symbol >= 0) & ~unknown[:, None]
        n_merged[unknown] = 0
        return symbol[kept], kept.sum(axis=1), merged[column < n_merged[:, None]], n_merged, unknown

    def _add(self, chunks: list[str], drops: list[tuple[int, ...]]) -> list[int]:
        """New outcomes of short chunks; -1 for those with unknown characters."""
        size, out = np.fromiter(map(len, chunks), np.int64, len(chunks)), np.full(len(chunks), -1, np.int64)
        order = np.argsort(size, kind="stable")
        for a in range(0, len(order), 4096):
            some = order[a:a + 4096]
            these = some.tolist()
            words, without = [chunks[i] for i in these], [drops[i] for i in these]
            ids, n_ids, merged, n_merged, unknown = self._side_by_side(words, without)
            good = ~unknown
            out[some[good]] = np.arange(self.ids.n, self.ids.n + int(good.sum()))
            self.chunk += compress(words, good.tolist())
            self.drops += compress(without, good.tolist())
            self.ids.add(ids, n_ids[good])
            self.merged.add(merged, n_merged[good])
        return out.tolist()

    def learn(self, chunks: list[str]) -> None:
        """Outcomes without drops of chunks that are not known yet."""
        short = [c for c in chunks if len(c) <= CACHE_CHUNK_CHARS]
        self.whole.update(zip(short, self._add(short, [()] * len(short))))
        for c in chunks:
            if self.whole.setdefault(c, -1) < 0 and len(c) <= CACHE_CHUNK_CHARS and (not self.below or self._fixed(c)):
                self.whole[c] = self._keep(c, self._ids(c, 0, 0))

    def _fixed(self, chunk: str) -> bool:
        """Whether a chunk has no possible merge."""
        rank, text = self.vocabulary.rank, chunk.replace(MARK, "\x00").replace(" ", MARK)
        return not any(a + b in rank for a, b in zip(text, text[1:]))

    def _keep(self, chunk: str, ids: np.ndarray) -> int:
        self.chunk.append(chunk)
        self.drops.append(())
        self.ids.add(ids, np.array([len(ids)]))
        self.merged.add(np.zeros(0, np.int64), np.array([0]))
        return self.ids.n - 1

    def _dropped(self, outcome: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Outcomes after the drop of a candidate, by its number among those merged."""
        step, which = np.unique(outcome * 64 + number, return_inverse=True)
        step = step.tolist()
        new = [s for s in step if s not in self.after]
        at = np.array(new, np.int64)
        candidates = self.merged.values[self.merged.first[at >> 6] + (at & 63)].tolist()
        drops = [(*self.drops[s >> 6], c) for s, c in zip(new, candidates)]
        self.after.update(zip(new, self._add([self.chunk[s >> 6] for s in new], drops)))
        return np.array(list(map(self.after.__getitem__, step)), np.int64)[which]

    def encode_flat(self, texts: list[str | None], variants: list[int], docs: list[int | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, edges of the texts)."""
        if self.ids.n > CACHE_OUTCOMES:
            self._forget()
        found = [_CHUNK.findall(" " + t) if t else [] for t in texts]
        count = np.array([len(f) for f in found], np.int64)
        chunks = [c for f in found for c in f]
        # A document without an id is known by its text.
        doc_key = np.array([self._key(v, (t or "") if d is None else str(d)) for t, v, d in zip(texts, variants, docs)], np.uint64)
        place = np.arange(len(chunks)) - np.repeat(np.cumsum(count) - count, count)
        key = _place_keys(np.repeat(doc_key, count), place)
        at = list(map(self.whole.get, chunks))
        missing = [i for i, x in enumerate(at) if x is None]
        new = {chunks[i] for i in missing}
        self.learn(list(new))
        for i in missing:
            at[i] = self.whole[chunks[i]]
        outcome = np.array(at, np.int64)
        open_ = np.flatnonzero(outcome >= 0) if self.below else np.zeros(0, np.int64)
        while len(open_):
            at = outcome[open_]
            merged, ends = self.merged.take(at)
            size = self.merged.size[at]
            hit = np.flatnonzero(_draws(np.repeat(key[open_], size), merged) < np.uint64(self.below))
            row, first = np.unique(np.searchsorted(ends, hit, "right"), return_index=True)
            open_ = open_[row]
            if len(open_):
                outcome[open_] = self._dropped(at[row], hit[first] - (ends - size)[row])
        known = self.ids.n
        variant = np.repeat(np.array(variants, np.int64), count)
        for i in np.flatnonzero(outcome < 0).tolist():
            outcome[i] = self._keep(chunks[i], self._ids(chunks[i], int(variant[i]), int(key[i])))
        ids, ends = self.ids.take(outcome)
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])]
        for rows in (self.ids, self.merged):            # outcomes of one occurrence, and long chunks
            rows.cut(known)
        del self.chunk[known:], self.drops[known:]
        for c in new:
            if len(c) > CACHE_CHUNK_CHARS:
                del self.whole[c]
        return ids, edges

    def encode_all(self, texts: list[str | None], variants: list[int], docs: list[int | None]) -> list[bytes]:
        """Ids of texts as little-endian int32 bytes."""
        ids, edges = self.encode_flat(texts, variants, docs)
        return [ids[a:b].astype("<i4").tobytes() for a, b in zip(edges[:-1], edges[1:])]

    def encode(self, text: str | None, variant: int, doc: int | None = None) -> bytes:
        return self.encode_all([text], [variant], [doc])[0]


def variant_of(doc_id: int | None, seed: int, variants: int) -> int:
    if doc_id is None:
        return 0
    return xxhash.xxh3_64_intdigest(b"%d" % doc_id, seed=seed) % variants


def _encode_batches(model_file: str, seed: int, rate: float, variants: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who = (model_file, seed, rate)
        if who not in _WORKER:
            _WORKER[who] = Encoder(Vocabulary(model_file), seed, rate)
        encoder = _WORKER[who]
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for a, b in slices(batch.column("text")):
                text = batch.column("text").slice(a, b - a)
                variant = [variant_of(d, seed, variants) for d in doc_ids[a:b]]
                ids, edges = encoder.encode_flat(text.to_pylist(), variant, doc_ids[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), text, pa.array(variant, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids))],
                    names=["doc_id", "text", "variant", "ids"])
    return run


@shipped
def encode(docs: DataFrame, model_file: str, seed: int = 1, rate: float = RATE, variants: int = VARIANTS) -> DataFrame:
    """(doc_id, text, variant, ids) for every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _encode_batches(model_file, seed, rate, variants), "doc_id long, text string, variant int, ids array<int>")


def _decode_batches(model_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model_file)
        for batch in batches:
            ids = batch.column("ids")
            edges, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
            decoded: list[bytes] = []
            for a in range(0, len(edges) - 1, 256):
                some = edges[a:a + 257]
                decoded += vocabulary.decode_all(values[some[0]:some[-1]], some - some[0])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary()).cast(pa.string())],
                names=[*batch.schema.names, "decoded"])
    return run


@shipped
def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``encoded`` with the column ``decoded``; it may have any other columns besides ``ids``."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.mapInArrow(_decode_batches(model_file), schema)
