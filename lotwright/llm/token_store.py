"""Token-ID output: whole texts to Parquet list columns, ordered by document, read back selectively.

Layout, one row per document in ascending ``doc_id`` (nulls first, then by
text hash) across the numbered parts of a folder:

``part``, ``local_start``, ``doc_id``, ``n_tokens``
    delta-encoded metadata (Parquet 2 pages, dictionary off).  ``local_start``
    is the number of ids before the document in its part.
``ids``
    ``list<int>``, dictionary-encoded: a vocabulary of up to 65,536 ids packs
    into 16 bits each.

Row groups are kept to ``ROW_GROUP_BYTES`` and pages to ``PAGE_ROWS`` rows;
Spark writes the column and offset indexes, so a filter on ``doc_id`` or a
read of the metadata touches few pages and no ids.

Defined results: null text is empty and holds only the end id; repeated rows
are written each; an empty table writes an empty folder with the schema; extra
columns are not read.
"""

from __future__ import annotations

import codecs
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.tables import materialize
from .shipping import ship, shipped
from .textops import _LOWER, _SPACE, slices, words_of

END_ID = 2
ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 2000
#: Beyond this number a worker forgets its cached words but those of the slice at hand (memory, not results).
CACHE_WORDS = 700_000
CACHE_WORD_BYTES = 64
_ENCODERS: dict[str, "WordEncoder"] = {}      # kept for the worker's life
_SEPARATOR = " <|startoftext|> "
#: Text bytes that are cut into words together.
SLICE_BYTES = 8 << 20
_PUNCT = np.zeros(256, bool)
_PUNCT[list(rb"!\"#$%&()*+,-./:;<=>?@[\]^_`{|}~")] = True                  # no apostrophe
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LOWER_BYTES = _LOWER.tobytes()
_WHITE = bytes(np.flatnonzero(_SPACE).tolist())
#: Longer runs of punctuation stay on their word (the whole tokenizer takes it then).
CUT_MARKS = 8
#: The bytes of a-z and of the letters from U+00C0 to U+00FF (0xC3 and one more; no signs of times and division).
_SECOND = np.zeros(256, bool)
_SECOND[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
_LATIN = bytes(range(97, 123)) + b"\xc3" + bytes(np.flatnonzero(_SECOND).tolist())
_LATIN_WORD = "".join(map(chr, (*range(97, 123), *(c for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)))))
#: Byte-level vocabularies spell a byte by its Latin-1 character if printable, else by the next one from U+0100.
_BYTE_CHARS = "".join(map(chr, (
    b if 33 <= b < 127 or 161 <= b < 173 or b > 173 else 256 + (b if b < 33 else b - 94 if b < 161 else 67)
    for b in range(256))))

SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType(), False),
    T.StructField("local_start", T.LongType(), False),
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_tokens", T.LongType(), False),
    T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
])


class WordEncoder:
    """Ids of white-space separated words, as little-endian uint32 bytes.

    The vocabulary drops white space and its pre-tokens never cross it, so a
    text's ids are the ids of its words in a row; every word goes through the
    tokenizer once and is then remembered.  Two more properties of it keep the
    words few: it lower-cases, and ASCII punctuation after a Latin letter is a
    pre-token of its own, so it is cut off a word's end.  (A word that may hold a
    special token stays as it is.)  A word of the letters a-z and U+00C0 to U+00FF
    is one pre-token that normalising only lower-cases, so the tokenizer's model
    takes its bytes directly.  All four are checked when the file is read.  Other
    words go through the whole tokenizer, many at once, with a special token
    between them.

    The words of a slice of texts are numbered in Arrow; only its distinct words
    are looked up, and their ids are gathered by number.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.separator = self.tokenizer.token_to_id(_SEPARATOR.strip())
        if self.separator is None:
            raise ValueError(f"the vocabulary has no {_SEPARATOR.strip()}")
        self._check()
        self.coded = [struct.pack("<I", i) for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.known: dict[bytes, bytes] = {}

    def _check(self) -> None:
        def ids(text: str) -> list[int]:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        marks = bytes(np.flatnonzero(_PUNCT).tolist()).decode()
        cuts = [(w + m, f"{w} {m}") for w in ("word", "wordé") for m in (*marks, marks)]
        whole = " ".join(f"Word{m}" for m in marks) + "\tX1\n'll\x0b\x0cÉa\r"
        if (any(ids(x) != ids(y) for x, y in cuts) or ids(whole) != ids(whole.lower())
                or ids(whole) != [i for w in whole.split() for i in ids(w)]):
            raise ValueError("the vocabulary must drop white space, lower-case, and set punctuation apart from letters")
        letters = [_LATIN_WORD, *(f"wo{c}rd" for c in _LATIN_WORD)]
        if any(ids(x) != [t.id for t in self.tokenizer.model.tokenize(self._spelled(x))] for x in letters):
            raise ValueError("the vocabulary must be byte-level and keep the letters of a word together")
        if any("<|" not in t.content for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("the added tokens of the vocabulary must hold <|")

    @staticmethod
    def _spelled(word: str) -> str:
        """A word of _LATIN_WORD's letters as the model's vocabulary spells it."""
        return codecs.charmap_decode(word.lower().encode(), "strict", _BYTE_CHARS)[0]

    @staticmethod
    def _words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """(words of the texts one after another, their number by text)."""
        w = words_of(texts)
        starts, ends, raw = w.starts, w.ends, w.raw
        if not len(starts):
            return pa.array([], pa.binary()).dictionary_encode(), np.zeros(len(texts), np.int64)
        # Of the words that end in punctuation, the last byte that is none.
        marked = np.flatnonzero(_PUNCT[raw[ends - 1]])
        last, begin = ends[marked] - 1, starts[marked]
        more = np.arange(len(marked))
        for _ in range(CUT_MARKS):
            last[more] -= 1
            more = more[last[more] >= begin[more]]
            more = more[_PUNCT[raw[last[more]]]]
        cut = (last >= begin) & _LETTER[raw[last]]
        cut |= (last > begin) & _SECOND[raw[last]] & (raw[last - 1] == 0xC3)
        special = np.flatnonzero(raw == ord("<"))
        special = special[raw[np.minimum(special + 1, len(raw) - 1)] == ord("|")]
        special = np.unique(np.searchsorted(starts, special, "right") - 1)
        cut &= ~np.isin(marked, special)
        at, tails = marked[cut], (ends[marked] - 1 - last)[cut]
        # The words' bytes, lower-cased and without the white space between them, are the values of a binary array.
        data, stops = raw.tobytes().translate(_LOWER_BYTES, _WHITE), np.cumsum(ends - starts)
        if len(special):
            changed = bytearray(data)
            for i in special.tolist():
                changed[stops[i] - (ends[i] - starts[i]):stops[i]] = raw[starts[i]:ends[i]].tobytes()
            data = bytes(changed)
        offsets = np.concatenate([[0], np.insert(stops, at, stops[at] - tails)])
        array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [
            None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
        return array.dictionary_encode(), np.diff(w.first + np.searchsorted(at, w.first))

    def _ids(self, words: list[bytes]) -> list[bytes]:
        tokenize, coded, out = self.tokenizer.model.tokenize, self.coded, [b""] * len(words)
        rest: list[int] = []
        for i, w in enumerate(words):
            if w.isalpha() and w.islower():                    # of bytes: a-z only
                out[i] = b"".join([coded[x.id] for x in tokenize(w.decode())])
            elif not w.translate(None, _LATIN) and (word := w.decode("utf-8", "replace")).isalpha():
                out[i] = b"".join([coded[x.id] for x in tokenize(self._spelled(word))])
            elif b"<|" in w:
                ids = self.tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids
                out[i] = np.array(ids, dtype="<u4").tobytes()
            else:
                rest.append(i)
        for a in range(0, len(rest), 1000):
            some = rest[a:a + 1000]
            text = _SEPARATOR.join(words[i].decode("utf-8", "replace") for i in some)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            edges = np.concatenate([[-1], np.flatnonzero(ids == self.separator), [len(ids)]])
            for i, x, y in zip(some, edges[:-1], edges[1:]):
                out[i] = ids[x + 1:y].tobytes()
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, their number by text)."""
        coded, counts = self._words(texts)
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()        # one call, no scalar per word
        ids = list(map(self.known.get, words))
        if len(self.known) > CACHE_WORDS:
            self.known = {w: x for w, x in zip(words, ids) if x is not None}
        unknown = [i for i, x in enumerate(ids) if x is None]
        new = [words[i] for i in unknown]
        for i, w, x in zip(unknown, new, self._ids(new)):
            ids[i] = x
            if len(w) <= CACHE_WORD_BYTES:
                self.known[w] = x
        edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))])
        each = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [
            None, pa.py_buffer(edges), pa.py_buffer(b"".join(ids))]).take(coded.indices)
        _, ends, data = each.buffers()
        ends = np.frombuffer(ends, np.int64)[:len(each) + 1] // 4
        return (np.frombuffer(data, "<i4")[:ends[-1]] if len(each) else np.zeros(0, np.int32),
                np.diff(ends[np.concatenate([[0], np.cumsum(counts)])]))


def _encode_batches(tokenizer_file: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer_file not in _ENCODERS:
            _ENCODERS[tokenizer_file] = WordEncoder(tokenizer_file)
        encoder = _ENCODERS[tokenizer_file]
        part, written = TaskContext.get().partitionId(), 0
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text, SLICE_BYTES):
                found, sizes = encoder.encode(text.slice(a, b - a))
                sizes = sizes + 1
                edges = np.concatenate([[0], np.cumsum(sizes)])
                ids = np.full(int(edges[-1]), end_id, np.int32)
                inside = np.ones(len(ids), bool)
                inside[edges[1:] - 1] = False
                ids[inside] = found
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(b - a, part, np.int32)), pa.array(written + edges[:-1]),
                    batch.column("doc_id").slice(a, b - a), pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids)),
                ], names=[f.name for f in SCHEMA])
                written += int(edges[-1])
    return run


@shipped
def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write the token files to ``path``.

    One range shuffle of the texts; each task then encodes and writes its part
    in order.  The text hash in the range key also splits a repeated doc_id.
    """
    tie = F.xxhash64("text")
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie))
    writer = (ordered.mapInArrow(_encode_batches(tokenizer_file, end_id), SCHEMA).write
              .option("parquet.block.size", ROW_GROUP_BYTES)
              .option("parquet.page.row.count.limit", PAGE_ROWS)
              .option("parquet.writer.version", "PARQUET_2_0")
              .option("parquet.enable.dictionary", "true"))
    for column in ("part", "local_start", "doc_id", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None,
                doc_ids: tuple[int, int] | None = None) -> DataFrame:
    """The token files: all or some columns, all documents or an inclusive doc_id range."""
    df = spark.read.schema(SCHEMA).parquet(path)
    if doc_ids is not None:
        df = df.where(F.col("doc_id").between(*doc_ids))
    return df.select(*columns) if columns else df


def part_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(part, base): ids in all parts before; reads metadata only, one row per part."""
    totals = read_tokens(spark, path, ["part", "n_tokens"]).groupBy("part").agg(
        F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(totals.select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "token-parts")


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        ids = ids.cast(pa.large_list(pa.int32())) if pa.types.is_list(ids.type) else ids
        edges = np.asarray(ids.offsets, dtype=np.int64)
        data = memoryview(np.asarray(ids.values).astype("<u4").tobytes())
        crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(edges[:-1], edges[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("local_start"), batch.column("doc_id"),
             pa.array(np.diff(edges)), pa.array(crc, pa.int64())],
            names=["part", "local_start", "doc_id", "n_tokens", "ids_crc32"])


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read from the files: doc_id, start, n_tokens, ids_crc32."""
    ship(spark)
    rows = read_tokens(spark, path).mapInArrow(
        _digest_batches, "part int, local_start long, doc_id long, n_tokens long, ids_crc32 long")
    return rows.join(part_offsets(spark, path), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_digest(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Write the token files to the shared scratch folder and digest them."""
    spark = docs.sparkSession
    path = scratch_path(spark, f"tokens-{uuid.uuid4().hex[:12]}")
    write_tokens(docs, path, tokenizer_file)
    return digest(spark, path)
