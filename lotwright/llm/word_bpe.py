"""BPE encoding and decoding over a table of distinct words.

1. Each task cuts its texts at ASCII white space and numbers the words of a
   block of about ``BLOCK_BYTES`` of text: a block is one row that holds its
   distinct words and, for every position of its texts, the number of the word.
   The blocks are written once, bucketed by their number, and so are their
   words, (word, block, place) bucketed by word: a word has one row per block.
2. The words are made distinct; every distinct word goes through the tokenizer
   once.  Its ids are joined to the table of pieces, which gives the word's
   decoded text.
3. Ids and pieces are joined to the words' places, packed and sent to their
   block, where they are put at the positions of the texts.

Cutting at white space is safe for a vocabulary that drops white space, which
is checked when the file is read: its pre-tokens never cross it, so the ids of
a text are the ids of its words in a row.  The vocabulary has no decoder, so
decoding joins the pieces by one space.

Defined results: null text is empty; a text without tokens has no ids and
decodes to the empty text; repeated rows each give a row, null ids too; an
empty table gives an empty result; extra columns are not read.  A text longer
than a block is a block of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .colocated import bucketed, buckets_of
from .shipping import ship
from .textops import slices

#: Text bytes of a block: larger blocks repeat fewer words, and a task holds one at a time.
BLOCK_BYTES = 32 << 20
#: Joined words of a task that are packed together.
PACK_ROWS = 1 << 19
ENCODE_WORDS = 1000
#: The table of pieces is broadcast; a vocabulary beyond this is refused.
MAX_PIECES = 1 << 21

_BLOCK = "block long, doc_ids array<long>, counts array<int>, codes binary, words array<string>"
_PACK = "block long, places binary, sizes binary, ids binary, pieces binary"
_TOKENIZERS: dict[str, tuple] = {}           # kept for the worker's life


def _tokenizer(path: str):
    """(tokenizer, separator token, separator id); checks what the method relies on."""
    if path not in _TOKENIZERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        specials = [(i, a.content) for i, a in t.get_added_tokens_decoder().items() if a.special]
        probe = "ab cd́ 'll x1"
        whole = t.encode(probe, add_special_tokens=False).ids
        parts = [i for w in probe.split() for i in t.encode(w, add_special_tokens=False).ids]
        if whole != parts or not specials or any(set(s) & set(" \t\n\v\f\r") for _, s in specials):
            raise ValueError("the vocabulary must drop white space and have a special token without it")
        _TOKENIZERS[path] = (t, specials[0][1], specials[0][0])
    return _TOKENIZERS[path]


def _zip(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unzip(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _pack_numbers(numbers: np.ndarray) -> bytes:
    """Byte by byte of significance, which compresses better than number by number."""
    return _zip(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unzip(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _block(number: int, ids: list[pa.Array], texts: list[pa.Array]) -> pa.RecordBatch:
    lists = pc.ascii_split_whitespace(pa.concat_arrays(texts))
    words = lists.flatten().dictionary_encode()
    codes, known = np.asarray(words.indices), words.dictionary
    real = np.asarray(pc.not_equal(known, ""))            # white space at the ends leaves empty words
    keep = real[codes] if len(codes) else np.zeros(0, bool)
    owner = np.repeat(np.arange(len(lists), dtype=np.int32), np.asarray(lists.value_lengths()))
    counts = np.bincount(owner[keep], minlength=len(lists)).astype(np.int32)
    codes, known = codes[keep], known.filter(pa.array(real))
    codes = (np.cumsum(real, dtype=np.int32) - 1)[codes]
    # Frequent words first, equals in order of the alphabet: small numbers and shared beginnings compress well.
    seen = pa.array(np.bincount(codes, minlength=len(known)))
    order = np.asarray(pc.sort_indices(pa.table({"seen": seen, "word": known}),
                                       sort_keys=[("seen", "descending"), ("word", "ascending")]))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    codes, known = rank[codes], known.take(pa.array(order))
    one = lambda a, kind: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a.cast(kind))
    doc_ids = pa.concat_arrays([i.cast(pa.int64()) for i in ids])
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), one(doc_ids, pa.int64()), one(pa.array(counts), pa.int32()),
         pa.array([_pack_numbers(codes)], pa.binary()), one(known, pa.string())],
        names=["block", "doc_ids", "counts", "codes", "words"])


def _blocks(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, ids, texts = TaskContext.get().partitionId() << 32, 0, [], []
        for batch in batches:
            text = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            for a, b in slices(text, block_bytes):
                part = text.slice(a, b - a)
                size = pc.sum(pc.binary_length(part)).as_py()
                if texts and held + size > block_bytes:
                    yield _block(number, ids, texts)
                    number, held, ids, texts = number + 1, 0, [], []
                ids.append(batch.column("doc_id").slice(a, b - a))
                texts.append(part)
                held += size
        if texts:
            yield _block(number, ids, texts)
    return run


def blocks_of(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The written blocks of ``docs`` (doc_id, text), bucketed by block."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bucketed(rows.mapInArrow(_blocks(block_bytes), _BLOCK), "block", "word_blocks", buckets_of(docs))


def word_places(blocks: DataFrame) -> DataFrame:
    """(word, block, place) of the blocks' words, written in buckets of the word."""
    n = buckets_of(blocks)
    rows = blocks.select("block", F.posexplode("words").alias("place", "word"))
    return bucketed(rows.repartition(n, "word").sortWithinPartitions("word", "block"), "word", "word_places", n)


def _encode_words(tokenizer_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, separator, sep_id = _tokenizer(tokenizer_file)
        joint = f" {separator} "
        for batch in batches:
            for a in range(0, batch.num_rows, ENCODE_WORDS):
                part = batch.column("word").slice(a, ENCODE_WORDS)
                words = part.to_pylist()
                out: list = [None] * len(words)
                plain = [i for i, w in enumerate(words) if separator not in w]
                ids = np.array(t.encode_batch_fast([joint.join(words[i] for i in plain)],
                                                   add_special_tokens=False)[0].ids, dtype=np.int32)
                edges = np.concatenate([[-1], np.flatnonzero(ids == sep_id), [len(ids)]])
                for i, x, y in zip(plain, edges[:-1], edges[1:]):
                    out[i] = ids[x + 1:y]
                for i, w in enumerate(words):
                    if out[i] is None:                  # holds the separator itself
                        out[i] = np.array(t.encode(w, add_special_tokens=False).ids, dtype=np.int32)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part, pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out)))],
                    names=["word", "ids"])
    return run


def pieces(spark: SparkSession, tokenizer_file: str) -> DataFrame:
    """(id, piece): the vocabulary with its added tokens; its size is checked."""
    t = _tokenizer(tokenizer_file)[0]
    known = t.get_vocab(with_added_tokens=True)
    if len(known) > MAX_PIECES:
        raise ValueError(f"{len(known)} pieces are too many to broadcast")
    if any(c in piece for piece in known for c in "\n\0"):
        raise ValueError("pieces must not hold line ends")
    ids, names = zip(*((i, p) for p, i in known.items()))
    return spark.createDataFrame(pa.table({"id": pa.array(ids, pa.int32()), "piece": pa.array(names)}))


def word_table(words: DataFrame, tokenizer_file: str) -> DataFrame:
    """(word, ids, text) of distinct ``words``: each encoded once, decoded by the join of ids to pieces.

    The ids are written in buckets of the word, so neither the join of a word's
    pieces nor what is joined to the result moves the table again.
    """
    encoded = bucketed(words.mapInArrow(_encode_words(tokenizer_file), "word string, ids array<int>"),
                       "word", "word_ids", buckets_of(words))
    known = F.broadcast(pieces(words.sparkSession, tokenizer_file))        # at most MAX_PIECES rows
    parts = encoded.select("word", F.posexplode_outer("ids").alias("at", "id")).join(known, "id", "left")
    return (parts.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("at", "id", "piece"))).alias("p"))
            .withColumn("p", F.expr("filter(p, x -> x.id IS NOT NULL)"))
            .select("word", F.expr("transform(p, x -> x.id)").alias("ids"),
                    F.expr("array_join(transform(p, x -> x.piece), ' ')").alias("text")))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, place, ids, text) to one row for each block, ``PACK_ROWS`` rows at a time."""
    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        t = t.take(pa.array(np.lexsort((t["place"].to_numpy(), t["block"].to_numpy())))).combine_chunks()
        block, place = t["block"].to_numpy(), t["place"].to_numpy()
        ids = t["ids"].combine_chunks()
        sizes = np.asarray(ids.value_lengths()).astype(np.int64)
        flat, edges = np.asarray(ids.flatten()), np.concatenate([[0], np.cumsum(sizes)])
        texts = t["text"].combine_chunks().cast(pa.large_string())
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), texts),
                                pa.scalar("\n", pa.large_string()))
        rows = [(int(block[a]), _pack_numbers(place[a:b]), _pack_numbers(sizes[a:b]),
                 _pack_numbers(flat[edges[a]:edges[b]]), _zip(joined[i].as_py().encode()))
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
        kinds = [pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                          names=["block", "places", "sizes", "ids", "pieces"])
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= PACK_ROWS:
            yield flush(held)
            held, n = [], 0
    if n:
        yield flush(held)


def _assemble(digest: bool):
    """Put the packed words of a block at the positions of its texts."""
    def run(blocks: pa.Table, packs: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            raise ValueError("words without their block")
        codes = _numbers(blocks["codes"][0].as_py())
        counts = np.asarray(blocks["counts"][0].values).astype(np.int64)
        n_words = int(codes.max()) + 1 if len(codes) else 0
        size, ids, text = np.zeros(n_words, np.int64), [None] * n_words, [b""] * n_words
        for pack in packs.to_pylist():
            places, sizes, flat = (_numbers(pack[k]) for k in ("places", "sizes", "ids"))
            size[places] = sizes
            edges = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).tolist()
            if digest:
                numbers = list(map(str, flat.tolist()))
                made = [" ".join(numbers[a:b]).encode() for a, b in zip(edges[:-1], edges[1:])]
            else:
                made = [flat[a:b] for a, b in zip(edges[:-1], edges[1:])]
            for p, i, x in zip(places.tolist(), made, _unzip(pack["pieces"]).split(b"\n")):
                ids[p], text[p] = i, x
        if any(i is None for i in ids):
            raise ValueError("a word of the block has no ids")
        if n_words and not size.all():                    # words without tokens leave no trace
            some = size[codes] > 0
            counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[some], minlength=len(counts))
            codes = codes[some]
        tokens = np.concatenate([[0], np.cumsum(size[codes])])
        edges = np.concatenate([[0], np.cumsum(counts)])
        n_tokens = tokens[edges[1:]] - tokens[edges[:-1]]
        out_ids, out_text = [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            some = codes[a:b].tolist()
            decoded = b" ".join([text[c] for c in some])
            if digest:
                out_ids.append(hashlib.sha256(b" ".join([ids[c] for c in some])).hexdigest())
                out_text.append(hashlib.sha256(decoded).hexdigest())
            else:
                out_ids.append(np.concatenate([ids[c] for c in some]).astype(np.int32) if some else np.zeros(0, np.int32))
                out_text.append(decoded.decode())
        return pa.table({"doc_id": blocks["doc_ids"].combine_chunks().flatten(), "n_tokens": pa.array(n_tokens, pa.int64()),
                         "ids": pa.array(out_ids, pa.string() if digest else pa.list_(pa.int32())),
                         "decoded": pa.array(out_text, pa.string())})
    return run


def encode_decode(docs: DataFrame, tokenizer_file: str, digest: bool = False,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every text; with ``digest`` the last two are SHA-256 digests.

    ``ids`` is what the tokenizer's encode gives without special tokens, and
    ``decoded`` what its decode gives for them.  The digest of the ids is that of
    their decimal numbers joined by a space.
    """
    ship(docs.sparkSession)
    blocks = blocks_of(docs, block_bytes)
    places = word_places(blocks)
    known = word_table(places.select("word").distinct(), tokenizer_file)
    packs = places.join(known, "word").select("block", "place", "ids", "text").mapInArrow(_pack, _PACK)
    schema = ("doc_id long, n_tokens long, ids string, decoded string" if digest else
              "doc_id long, n_tokens long, ids array<int>, decoded string")
    whole = blocks.select("block", "doc_ids", "counts", "codes")
    return whole.groupBy("block").cogroup(packs.groupBy("block")).applyInArrow(_assemble(digest), schema)
