"""Word BPE, centroid clustering and whitening against brute-force versions."""

import hashlib
import math

import numpy as np
import public_tokenizers
import pytest

from lotwright.llm import centroids, whitening, word_bpe
from support import documents, edge_docs, empty_docs

FILE = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


def encoded(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(FILE)
    ids = t.encode(text or "", add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("block_bytes", [1 << 10, 32 << 20])
def test_word_bpe_equals_the_library(spark, block_bytes):
    hard = ["é é   x y", "<|endoftext|>a<|startoftext|> b", "\x85", "  ", "don't 'LL I'M", "ΑΣ Σ",
            "a​b\x1cc", "日本語 テキスト", "1234 5.6.7", "…—\"quoted\"'s"]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(hard)], "doc_id long, text string")
    docs = edge_docs(spark).select("doc_id", "text").unionByName(extra)
    got = sorted((str(r.doc_id), r.n_tokens, list(r.ids), r.decoded)
                 for r in word_bpe.encode_decode(docs, FILE, block_bytes=block_bytes).collect())
    want = sorted((str(r.doc_id), len(encoded(r.text)[0]), *encoded(r.text)) for r in docs.collect())
    assert got == want


def test_word_bpe_digests_and_whole_table(spark):
    rows = {r.doc_id: r for r in word_bpe.encode_decode(documents(spark, SMALL), FILE, digest=True).collect()}
    for r in documents(spark, SMALL).collect():
        ids, text = encoded(r.text)
        assert rows[r.doc_id].n_tokens == len(ids)
        assert rows[r.doc_id].ids == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[r.doc_id].decoded == hashlib.sha256(text.encode()).hexdigest()


def test_word_bpe_of_nothing(spark):
    assert word_bpe.encode_decode(empty_docs(spark), FILE).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, ids long, block long, dim int, v string")


def clustered(rows, k, rounds, dim):
    """Plain rounds over exact whole numbers."""
    x = [(i, [centroids.whole_number(c) for c in e]) for i, e in rows]
    cent = [v for _, v in sorted((r for r in x if r[0] is not None),
                                 key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        member = {}
        for _, v in x:
            member.setdefault(nearest(v)[1], []).append(v)
        for j, vs in member.items():
            cent[j] = [sum(col) // len(vs) for col in zip(*vs)]
    return cent, sorted(((str(i), nearest(v)[1], nearest(v)[0]) for i, v in x))


@pytest.mark.parametrize("scale", [1.0, 1e7])
def test_centroids_equal_plain_rounds(spark, scale):
    """Small blocks, ties, copies, a null id; large components go the way of exact integers."""
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(150, 4)) + rng.integers(0, 5, size=(150, 1)) * 2, 2) * scale
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(500 + i, [0.0] * 4) for i in range(30)] + [(None, [1.0] * 4)]
    bad = [(900, None), (901, [1.0, None, 2.0, 3.0]), (902, [math.nan] * 4), (903, [math.inf] * 4), (904, [1.0])]
    table = vectors(spark, [(i, e, 1, 2, 3, "x") for i, e in rows + bad])
    out = centroids.cluster(table, k=7, rounds=4, dim=4, block_rows=16)
    cent, want = clustered(rows, 7, 4, 4)
    got = out.rows().collect()
    assert out.centroids == cent
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in got) == [
        (i, j, d if d < 1 << 63 else None) for i, j, d in want]
    inertia = sum(d for _, _, d in want)
    assert {r.inertia for r in got} == {inertia if inertia < 1 << 63 else None}
    assert out.scanned[0] == len(rows) and sum(out.scanned[1:]) < 4 * len(rows)      # bounds hold vectors back


def test_centroids_join_buckets_without_an_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = centroids.cluster(vectors(spark, [(i, [float(i)] * 4, 1, 2, 3, "x") for i in range(50)]), k=3, dim=4)
        plan = out.blocks.join(out.state, "block")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_centroids_of_nothing(spark):
    assert centroids.cluster(vectors(spark, []), dim=4).rows().collect() == []
    few = centroids.cluster(vectors(spark, [(1, [1.0] * 4, 1, 2, 3, "x")]), dim=4).rows().collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in few] == [(1, 0, 0)]


def test_feast_finds_every_component():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    for values in (np.linspace(1, 40, 40), np.repeat([5.0, 3.0, 1.0, 1e-3], 10), 10.0 ** np.linspace(-6, 4, 40)):
        v = (q * values) @ q.T
        v = (v + v.T) / 2
        assert [whitening.count_below(v, s) for s in (0.5, 2.0, 4.0)] == [int((values < s).sum()) for s in (0.5, 2.0, 4.0)]
        found, x = whitening.top_components(v, 32)
        want = np.sort(values)[::-1][:32]
        assert np.allclose(found, want, rtol=1e-9, atol=1e-12 * values.max())
        assert np.abs(x.T @ x - np.eye(len(found))).max() < 1e-12
        assert np.abs(v @ x - x * found).max() < 1e-11 * values.max()


def test_whitening_equals_an_eigensolver(spark):
    rng = np.random.default_rng(7)
    data = rng.standard_normal((300, 6)) @ rng.standard_normal((6, 6)) * 3
    rows = [(i, d.tolist(), 1, 2, 3, "x") for i, d in enumerate(data)]
    rows += [(None, data[0].tolist(), 1, 2, 3, "x"), (990, None, 1, 2, 3, "x"), (991, [math.nan] * 6, 1, 2, 3, "x"),
             (992, [], 1, 2, 3, "x"), (993, [1.0, 2.0], 1, 2, 3, "x"), (994, [None] * 6, 1, 2, 3, "x")]
    out = whitening.whiten(vectors(spark, rows)).collect()
    x = np.array([[math.floor(64 * c) + 1000000 for c in r[1]] for r in rows[:301]], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = np.array([[float(n * a - b) / n for a, b in zip(row, s)] for row in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    w = (centred @ u[:, ::-1]) / np.sqrt(e[::-1])
    at = {str(r[0]): i for i, r in enumerate(rows[:301])}
    assert len(out) == 301 * 6 and {r.n for r in out} == {301}        # the single vector of two components has no variance
    for r in out:
        i, j = at[str(r.vec_id)], r.component - 1
        assert abs(abs(r.whitened) - abs(w[i, j])) < 1e-9
        assert abs(r.explained - e[::-1][j] / e.sum()) < 1e-12 and r.identity_error < 1e-9
        assert r.deviation == sum((n * a - b) ** 2 for a, b in zip(x[i], s))


def test_whitening_of_nothing_and_of_huge_entries(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 1, 2, 3, "x")] * 3)).collect() == []      # no variance
    huge = [(i, [float(i) * 1e15, -1e300 if i % 2 else 1.0], 1, 2, 3, "x") for i in range(20)]
    out = whitening.whiten(vectors(spark, huge)).collect()
    assert len(out) == 40 and all(abs(r.identity_error) < 1e-4 and r.deviation is None for r in out)
