"""Token store, merge-dropout, top-k search, registration and the pipeline."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

import corpus_pipeline
from lotwright.llm import piece_dropout as D
from lotwright.llm import queries
from lotwright.llm import token_store as S
from lotwright.llm import topk_search as K
from lotwright.session import scratch_path
from support import documents, edge_docs, empty_docs

SMALL = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def brute_tokens(rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(WORD_BPE)
    out, start = [], 0
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_match_the_library(spark):
    rows = sorted(tuple(r) for r in documents(spark, SMALL).select("doc_id", "text").collect())
    assert sorted(tuple(r) for r in S.encode_and_digest(documents(spark, SMALL), WORD_BPE).collect()) == brute_tokens(rows)


def test_token_files_edges(spark):
    docs = edge_docs(spark)
    got = sorted((tuple(r) for r in S.encode_and_digest(docs, WORD_BPE).collect()), key=lambda r: r[1])
    rows = {}
    for r in docs.select("doc_id", "text").collect():
        rows.setdefault(r["doc_id"], []).append(r["text"])
    assert [r[0] for r in got] == sorted((d for d, v in rows.items() for _ in v), key=lambda d: (d is not None, d or 0))
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    single = {w[0]: w[2:] for d, v in rows.items() for w in brute_tokens([(d, v[0])])}
    assert all(r[2:] == single[r[0]] for r in got)
    assert S.encode_and_digest(empty_docs(spark), WORD_BPE).count() == 0


def test_token_files_are_read_selectively(spark):
    path = scratch_path(spark, "tokens-selective-test")
    docs = documents(spark, SMALL)
    S.write_tokens(docs.limit(0), path + "-empty", WORD_BPE)
    import uuid
    path += uuid.uuid4().hex
    S.write_tokens(docs, path, WORD_BPE)
    some = S.read_tokens(spark, path, ["doc_id", "n_tokens"], (10, 20))
    assert sorted(r[0] for r in some.collect()) == list(range(10, 21))
    plan = some._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[-1] and "GreaterThanOrEqual(doc_id,10)" in plan


def test_word_encoder_fuzz():
    import random
    from tokenizers import Tokenizer
    tokenizer, encoder = Tokenizer.from_file(WORD_BPE), S.WordEncoder(WORD_BPE)
    rng = random.Random(1)
    alphabet = list("aAbZ.,'!?09 \t\n\r\x0b\x0cé  ́Σß<|>-_#") + [
        "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "it's,", "...", "a.b", "\x1c", "\x85"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        ids, sizes = encoder.encode(pa.array([text, None, text]))
        assert sizes.tolist() == [len(want), 0, len(want)] and ids.tolist() == want * 2, text


class Counted:
    """A tokenizer that counts the texts it encodes whole."""
    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.texts = tokenizer, tokenizer.model, []

    def encode(self, text, **kw):
        self.texts.append(text)
        return self.tokenizer.encode(text, **kw)

    def encode_batch_fast(self, texts, **kw):
        self.texts += texts
        return self.tokenizer.encode_batch_fast(texts, **kw)


def test_latin_words_go_straight_to_the_model():
    encoder = S.WordEncoder(WORD_BPE)
    library, encoder.tokenizer = encoder.tokenizer, Counted(encoder.tokenizer)
    letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
    texts = ["über, Straße. ENUNGÖÄ!!! équechoi (naïve", " ".join(f"{c}b{c}{c}a" for c in letters) + "\t" + "".join(letters)]
    ids, _ = encoder.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]
    # Before, all words but those of plain ASCII letters went through the whole tokenizer.
    assert encoder.tokenizer.texts == [S._SEPARATOR.join([",", ".", "!!!", "(naïve"])]
    others = ["3×4÷2 a×b", "e\u0301te \u0301 éa\u0301", "ªµº œuvre ŒUVRE", "x!!!!!!!! x!!!!!!!!! É!!!!!!!!!!", "×! ÷, a×. é! É? ç' !é", "Ã", "é.",
              "<|ENDOFTEXT|>É, É<|endoftext|>É. <", "|É", "!" * 20 + " " + "é" * 3000]
    ids, sizes = encoder.encode(pa.array(others))
    want = [library.encode(t, add_special_tokens=False).ids for t in others]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_a_full_cache_keeps_the_words_at_hand(monkeypatch):
    monkeypatch.setattr(S, "CACHE_WORDS", 3)
    encoder = S.WordEncoder(WORD_BPE)
    first = encoder.encode(pa.array(["one two three four five"]))[0].tolist()
    coded, encode_new = [], encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda words: coded.extend(words) or encode_new(words))
    again = encoder.encode(pa.array(["five nine one", None, ""]))
    assert coded == [b"nine"] and sorted(encoder.known) == [b"five", b"nine", b"one"]      # all three coded anew before
    assert again[1].tolist() == [3, 0, 0] and again[0].tolist()[::2] == [first[4], first[0]]
    ids, sizes = encoder.encode(pa.array(["", None]))
    assert ids.tolist() == [] and sizes.tolist() == [0, 0]


def test_a_vocabulary_without_latin_letters_as_bytes_is_refused(tmp_path):
    import json
    spec = json.loads(open(WORD_BPE).read())
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[a-z]+|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    path = tmp_path / "split.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="byte-level"):
        S.WordEncoder(str(path))


@pytest.fixture(scope="module")
def vocabulary():
    return D.Vocabulary(PIECES)


def test_no_dropout_is_the_library(spark, vocabulary):
    from sentencepiece import SentencePieceProcessor
    model, encoder = SentencePieceProcessor(model_file=PIECES), D.Encoder(vocabulary, 1, 0.0)
    for r in documents(spark, SMALL).select("text").collect() + edge_docs(spark).where("doc_id < 15").select("text").collect():
        assert np.frombuffer(encoder.encode(r[0] or "", 0), "<i4").tolist() == model.encode(r[0] or "")


def test_dropout_is_keyed_and_lossless(spark, vocabulary):
    one, same, other = D.Encoder(vocabulary, 1, 0.1), D.Encoder(vocabulary, 1, 0.1), D.Encoder(vocabulary, 2, 0.1)
    texts = [r[0] or "" for r in edge_docs(spark).select("text").collect()] + [
        r[0] for r in documents(spark, SMALL).limit(50).select("text").collect()]
    ids = [one.encode(t, 0) for t in texts]
    assert ids == [same.encode(t, 0) for t in reversed(texts)][::-1]
    assert ids != [other.encode(t, 0) for t in texts] and ids != [one.encode(t, 1) for t in texts]
    assert [vocabulary.decode(np.frombuffer(i, "<i4").tolist()) for i in ids] == texts
    assert len({tuple(one.pieces(" segmentation", v)) for v in range(40)}) > 3
    everything = D.Encoder(vocabulary, 1, 1.0)
    assert everything.pieces(" the", 0) == [D.MARK, "t", "h", "e"]


def test_dropout_varies_inside_a_document(spark, vocabulary):
    one, n = D.Encoder(vocabulary, 1, 0.1), 400
    seen = {}
    for doc in (7, 8):
        got = np.frombuffer(one.encode("segmentation " * n, 0, doc), "<i4").tolist()
        text = [vocabulary.raw[i].decode() for i in got]
        starts = [i for i, t in enumerate(text) if t.startswith(" ")]
        seen[doc] = ["|".join(text[a:b]) for a, b in zip(starts, starts[1:] + [len(text)])][:n]
    assert all(s.replace("|", "") == " segmentation" for s in seen[7])
    assert len(set(seen[7])) > 8 and seen[7] != seen[8]         # 4 in the whole corpus before
    plain = np.frombuffer(D.Encoder(vocabulary, 1, 0.0).encode("segmentation", 0), "<i4").tolist()
    assert seen[7].count("|".join(vocabulary.raw[i].decode() for i in plain)) > n // 10


def test_cached_outcomes_are_those_of_the_heap(spark, vocabulary):
    for rate in (0.0, 0.1, 0.6, 1.0):
        one = D.Encoder(vocabulary, 3, rate)
        for r in documents(spark, SMALL).limit(20).collect() + edge_docs(spark).where("doc_id in (8, 10, 11, 15)").collect():
            chunks = D._CHUNK.findall(" " + r["text"])
            doc = np.full(len(chunks), one._key(2, str(r["doc_id"])), np.uint64)
            keys = D._place_keys(doc, np.arange(len(chunks))).tolist()
            want = np.concatenate([one._ids(c, 2, k) for c, k in zip(chunks, keys)])
            assert np.frombuffer(one.encode(r["text"], 2, r["doc_id"]), "<i4").tolist() == want.tolist()


def test_dropout_query_round_trip(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        encoded = D.encode(docs, PIECES)
        out = D.decode(encoded, PIECES).collect()
        assert len(out) == docs.count() and all(r["decoded"] == (r["text"] or "") for r in out)


def brute_topk(rows, k):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)
        vectors[i] = min(vectors.get(i, q), q)
    out = []
    for q, v in vectors.items():
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors.items() if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("cells", [64, 1 << 18])
def test_topk_matches_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(K, "BLOCK_CELLS", cells)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(160)]
    rows += [(200 + i, [1.0] * 6) for i in range(60)] + [(300, None), (350, [1.0, None] + [0.0] * 4), (400, [float("nan")] * 6),
             (450, [float("inf")] * 6), (500, [1.0, 2.0]), (501, [3.0, 4.0]), (550, []), (None, [1.0] * 6), (250, [1.0] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id long, dim string".split(", id")[0])
    vectors = K.quantised(table)
    got = sorted(tuple(r) for r in K.search(vectors, vectors.where("id % 50 = 0")).collect())
    assert got == brute_topk(rows, 5)
    empty = vectors.limit(0)
    assert K.search(empty, empty).count() == 0


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.REGISTRY) == list(range(1, 14))
    import __spark_entry__
    assert set(queries.REGISTRY) | {"pipeline"} <= set(__spark_entry__.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near", "pii", "pack"]


def test_pipeline_stages(spark):
    from lotwright.llm import line_dedup, near_dedup, packing, pii, quality_rules
    from lotwright.sources.tables import materialize
    docs = documents(spark, SMALL)
    columns, sf = docs.columns, SMALL
    kept = materialize(corpus_pipeline.quality(spark, docs, sf), "t")
    good = {r["doc_id"] for r in quality_rules.report(docs).where("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == good and kept.columns == columns
    lines = materialize(corpus_pipeline.lines(spark, kept, sf), "t")
    removed = {r["doc_id"]: set(map(int, filter(None, r["removed"].split(",")))) for r in line_dedup.report(kept).collect()}
    want = {}
    for r in kept.collect():
        left = [x for i, x in enumerate(r["text"].split("\n")) if i not in removed[r["doc_id"]]]
        if any(x.split() for x in left):
            want[r["doc_id"]] = "\n".join(left)
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == want and lines.columns == columns
    near = materialize(corpus_pipeline.near(spark, lines, sf), "t")
    single = {r["doc_id"] for r in near_dedup.near_duplicates(lines, 5, 80).where("kept").collect()}
    assert {r["doc_id"] for r in near.collect()} == single and near.columns == columns
    clean = materialize(corpus_pipeline.personal(spark, near, sf), "t")
    assert clean.columns == columns and clean.count() == near.count()
    assert not any(pii.base_spans(r["text"]) for r in clean.collect())
    packed = corpus_pipeline.pack(spark, clean, sf)
    assert {r["doc_id"] for r in packed.collect()} == single
    assert packed.count() == packing.pieces(clean).count()


def test_pairs_are_found_by_hash(spark, vocabulary):
    v, rng = vocabulary, np.random.default_rng(3)
    some = rng.integers(0, len(v.pairs), 3000)
    left = np.concatenate([v.pairs[some] // v.n_pieces, rng.integers(-2, v.n_pieces, 3000)])
    right = np.concatenate([v.pairs[some] % v.n_pieces, rng.integers(-2, v.n_pieces, 3000)])
    known = {int(p): (int(m), int(r)) for p, m, r in zip(v.pairs, v.merged, v.merge_rank)}
    merged, rank = v.merges(left, right)
    for a, b, m, r in zip(left.tolist(), right.tolist(), merged.tolist(), rank.tolist()):
        want = known.get(a * v.n_pieces + b) if a >= 0 and b >= 0 else None
        assert (m, r) == want if want else r == D.NO_MERGE
    assert (v.slots >= 0).sum() == len(v.pairs)                 # sorted pairs and a binary search before


def test_known_chunks_and_words_are_looked_up_once(spark, vocabulary):
    class Once(dict):
        reads = 0

        def get(self, *key):
            Once.reads += 1
            return super().get(*key)

        def __getitem__(self, key):
            Once.reads += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            Once.reads += 1
            return super().__contains__(key)

    one = D.Encoder(vocabulary, 1, 0.1)
    first = one.encode("known words stay known " * 50, 0, 1)
    one.whole = Once(one.whole)
    assert one.encode("known words stay known " * 50, 0, 1) == first
    assert Once.reads == len(D._CHUNK.findall(" " + "known words stay known " * 50))

    words = S.WordEncoder(WORD_BPE)
    texts = pa.array(["known words stay known, Words " * 50, None, ""])
    ids, sizes = words.encode(texts)
    words.known, Once.reads = Once(words.known), 0
    again, n = words.encode(texts)
    assert again.tolist() == ids.tolist() and n.tolist() == sizes.tolist()
    assert Once.reads == len(words.known)                       # twice before
