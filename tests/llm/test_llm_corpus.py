"""Near and line dedup, packing, language model: operators on the whole corpus."""

import math
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lotwright.llm import line_dedup as L
from lotwright.llm import lm_scoring as M
from lotwright.llm import near_dedup as N
from lotwright.llm import packing as K
from lotwright.llm.components import components
from lotwright.llm.textops import words_of
from support import BASE, documents, edge_docs, empty_docs, words

SMALL = "/root/testdata/sf0.001"


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (-5, -9), (-5, -9)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 130))
    assert got[-5] == got[-9] == -9 and 7 in got and len(got) == 41 + 30 + 2
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingles(text, size):
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def brute_near(rows, size, percent):
    """(doc_id, set size, smallest id reachable) by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    low = list(range(len(rows)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and sets[j]:
                a, b = sorted((root(i), root(j)))
                low[b] = a
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)].append(d)
    return Counter((d, len(sets[i]), (min(ids[root(i)]) if ids[root(i)] else None) if sets[i] else d)
                   for i, (d, _) in enumerate(rows))


def copies(n, seed=0):
    """Near copies of one text, each with some words of its own."""
    rng = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(120)]
    out = []
    for d in range(n):
        w = list(base)
        for p in rng.choice(len(w), rng.integers(1, 9), replace=False):
            w[p] = f"own{d}_{p}"
        out.append((d, " ".join(w)))
    return out


@pytest.mark.parametrize("cold", [2, 64])
def test_near_dedup_matches_brute_force(spark, monkeypatch, cold):
    monkeypatch.setattr(N, "COLD", cold)        # 2: nearly all lists go the way of large groups
    rng = np.random.default_rng(1)
    short = [(1000 + i, " ".join(rng.choice(list("abcdef"), rng.integers(0, 7)))) for i in range(60)]
    around_k = [(2000 + 10 * k + j, " ".join(f"k{k}_{i}" for i in range(50 + j * 4))) for k in range(4) for j in range(8)]
    docs = spark.createDataFrame(copies(90) + short + around_k, "doc_id long, text string")
    rows = [tuple(r) for r in docs.collect()]
    got = N.near_duplicates(docs, 2, 80).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_near(rows, 2, 80)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_dedup_common_shingles_join_no_unlike_documents(spark, monkeypatch):
    """Every shingle in more than ``COLD`` documents: they made one family of them all, compared pair by pair."""
    rng = np.random.default_rng(9)
    rows = [(d, " ".join(f"w{i}" for i in rng.integers(0, 30, 150))) for d in range(400)]
    rows += [(400 + d, t + " end") for d, t in rows[:5]]
    found = {}

    def edges(pairs, name="components"):
        found[name] = pairs.count()
        return components(pairs, name)
    monkeypatch.setattr(N, "components", edges)
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_near(rows, 2, 80)
    assert found["near-families"] == 0 and found["near-components"] == 5


def test_near_dedup_edges_and_small_table(spark):
    for docs, size in ((edge_docs(spark), 2), (documents(spark, SMALL), 5)):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        got = N.near_duplicates(docs, size, 80).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_near(rows, size, 80)
    assert N.near_duplicates(empty_docs(spark), 2, 80).count() == 0
    kept = N.keep_one(edge_docs(spark))
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert kept.columns == edge_docs(spark).columns and ids.count(8) == 1 and 7 not in ids and 1 in ids


def text_order(text):
    """Spark's xxhash64 of a text, which orders the texts of one id."""
    return np.array(xxhash.xxh64_intdigest(text.encode(), seed=42), np.uint64).astype(np.int64).item()


def brute_lines(rows):
    """(doc_id, removed line numbers) by comparing each line with every earlier one."""
    def key(d, t):
        return d is not None, d or 0, text_order(t or "")
    lines = [(key(d, t), i, w) for d, t in set(rows) for i, x in enumerate((t or "").split("\n"))
             if len(w := words(x)) >= L.MIN_WORDS]
    lines.sort(key=lambda x: x[:2])
    removed = defaultdict(set)
    for i, (d, n, w) in enumerate(lines):
        for e, m, v in lines[:i]:
            if (e, m) < (d, n) and (v == w or min(len(v), len(w)) >= L.MIN_NEAR_WORDS and L.within_one_edit(v, w)):
                removed[d].add(n)
                break
    return Counter((d, ",".join(map(str, sorted(removed[key(d, t)])))) for d, t in rows)


def report_of(docs):
    return Counter((r["doc_id"], r["removed"]) for r in L.report(docs).collect())


def test_keep_one_of_repeated_and_null_ids(spark):
    extra = f"{BASE} and one more word to make it long enough for a copy of it"
    rows = [(3, extra), (5, extra + " tail"), (5, "a text of its own that nobody else has here"), (5, extra), (None, extra + " end"),
            (None, "null own words are not those of others at all"), (None, "null own words are not those of others at all"),
            (None, None), (None, ""), (4, ""), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(tuple(r) for r in N.keep_one(docs).collect())
    assert kept == Counter({(3, extra): 1, rows[2]: 1, rows[5]: 1, (None, None): 1, (None, ""): 1, (4, ""): 1})
    got = N.near_duplicates(docs, 5, 80).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_near(rows, 5, 80)


def test_near_dedup_of_many_rows_without_id(spark):
    rows = [(None, t) for _, t in copies(60, 3)] + [(1, copies(61, 3)[60][1])]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_near(rows, 2, 80)


def test_one_word_edits():
    x = BASE.split()
    assert L.within_one_edit(x, x) and L.within_one_edit(x, x[:3] + ["z"] + x[4:]) and L.within_one_edit(x, x[1:])
    assert L.within_one_edit(x, x + ["z"]) and not L.within_one_edit(x, x[2:]) and not L.within_one_edit(x, x[::-1])
    assert L.within_one_edit([], [1]) and not L.within_one_edit([1, 2], [2, 1])


def test_line_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    base = [f"t{i}" for i in range(12)]
    rows = []
    for d in range(60):
        text = []
        for _ in range(rng.integers(1, 5)):
            w = list(base[:rng.integers(2, 13)])
            for _ in range(rng.integers(0, 3)):
                p = int(rng.integers(0, len(w)))
                w = [w[:p] + w[p + 1:], w[:p] + ["X"] + w[p:], w[:p] + [f"y{rng.integers(3)}"] + w[p + 1:]][rng.integers(3)] or w
            text.append("  ".join(w))
        rows.append((d, "\n".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert report_of(docs) == brute_lines(rows)


def test_line_dedup_tells_rows_of_one_id_apart(spark):
    one, two, near = "shared one two three", "uno dos tres cuatro", "a b c d e f g h i j"
    rows = [(5, f"{two}\n{one}"), (5, "cinco seis siete\nnot a copy at all"), (3, f"{one}\nok"), (9, "ok\nown line"),
            (None, f"{near}\nnull own"), (None, f"{near} k\nother null own"), (None, f"{one}\nthird"), (None, f"{one}\nthird"),
            (7, f"{near}\nseven"), (7, f"{near} k"), (7, f"{near} k"), (8, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert report_of(docs) == brute_lines(rows)
    texts = [r["text"] for r in L.dedup(docs).collect() if r["text"]]
    assert any("not a copy at all" in t for t in texts) and any("own line" == t for t in texts)


def test_line_dedup_edges(spark):
    docs = edge_docs(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = L.report(docs).collect()
    assert Counter((r["doc_id"], r["removed"]) for r in got) == brute_lines(rows) and len(got) == len(rows)
    out = L.dedup(docs)
    by_id = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == docs.columns and 7 not in by_id and by_id[2]["text"] is None and by_id[3]["text"] == ""
    assert by_id[1]["text"] == rows[0][1] and by_id[1]["n"] == 0
    assert L.report(empty_docs(spark)).count() == 0 and L.dedup(empty_docs(spark)).count() == 0


def test_best_fit_takes_the_tightest_compatible_bin():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n, cap = 200, 60
        lengths = np.sort(rng.integers(0, cap + 1, n))[::-1]
        conflicts = [rng.integers(-1, 8, n), rng.integers(-1, 90, n)]
        got = K.best_fit(lengths, conflicts, cap)
        room, held = {}, defaultdict(set)
        for i in range(n):
            fits = [r for b, r in room.items() if r >= lengths[i]
                    and not any(c[i] >= 0 and (j, c[i]) in held[b] for j, c in enumerate(conflicts))]
            b = int(got[i])
            assert room.get(b, cap) == (min(fits) if fits else cap) and (b in room) == bool(fits)
            room[b] = room.get(b, cap) - lengths[i]
            for j, c in enumerate(conflicts):
                if c[i] >= 0:
                    assert (j, c[i]) not in held[b]
                    held[b].add((j, c[i]))


def test_packing_covers_every_word_without_conflicts(spark):
    for docs in (edge_docs(spark), documents(spark, SMALL)):
        rows = docs.select("doc_id", "text", "source").collect()
        got = K.pack(docs, capacity=512, group_items=64).collect()
        total, want = Counter(), Counter()
        for r in got:
            total[r["doc_id"]] += r["n_words"]
        for r in rows:
            want[r["doc_id"]] += len(words(r["text"]))
        assert total == want
        source = {r["doc_id"]: r["source"] for r in rows}
        bins = defaultdict(list)
        for r in got:
            bins[r["bin_id"]].append(r)
        for members in bins.values():
            assert sum(r["n_words"] for r in members) <= 512
            named = [source[r["doc_id"]] for r in members if source[r["doc_id"]] is not None]
            assert len(named) == len(set(named))
    assert K.pack(empty_docs(spark)).count() == 0


def test_packing_spreads_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "one two three", "s")] * 300 + [(2, "x " * 50, "t")], "doc_id long, text string, source string")
    packed = K.pack(docs, capacity=32, group_items=32).collect()
    assert len(packed) == 302 and len({r["bin_id"] for r in packed}) >= 300
    groups = Counter(r["bin_id"] >> 32 for r in packed if r["doc_id"] == 1)
    assert len(groups) > 3 and max(groups.values()) < 150


def test_packing_reads_each_text_twice(spark):
    """Once for words and sketches, once for the sets of linked documents; no pass of its own counts words."""
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        reads.add(1)
        return text

    rows = [(i, f"text {i} of a few words " * 3, f"s{i}") for i in range(40)] + [(40, None, "s"), (None, " ", None)]
    rows += [(50 + i, " ".join(f"w{j}" for j in range(100)) + f" end{i}", f"t{i}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("text", seen("text"))
    got = K.pack(docs).collect()
    assert sorted(r["n_words"] for r in got) == [0, 0] + [18] * 40 + [101] * 3
    assert reads.value <= 2 * len(rows)


def test_components_carry_words_and_a_column(spark):
    rows = [(1, BASE, "a"), (7, BASE.replace("lazy", "tired"), "b"), (7, BASE + " " + BASE, None), (3, " \t\n", "d"),
            (4, None, "e"), (None, "one", "f"), (2, BASE, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own string")
    got = Counter(tuple(r) for r in N.with_components(docs, "own", 2, 50).collect())
    n = len(BASE.split())
    assert got == Counter({("a", n, 1): 2, ("b", n, 1): 1, (None, 2 * n, 1): 1, ("d", 0, None): 1, ("e", 0, None): 1,
                           ("f", 1, None): 1})


@pytest.mark.parametrize("size", [1, 2, 5])
def test_shingle_sets_of_short_and_long_rows(size):
    rng = np.random.default_rng(size)
    texts = [" ".join(rng.choice(["a", "B", "b", "cc", "É"], n)) for n in rng.integers(0, 12, 300)]
    values, first = N.shingle_sets(words_of(pa.array(texts)), size)
    names = {}
    for text, a, b in zip(texts, first[:-1], first[1:]):
        w = words(text)
        brute = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
        assert b - a == len(brute) and (np.diff(values[a:b]) > 0).all()
        assert names.setdefault(frozenset(brute), tuple(values[a:b])) == tuple(values[a:b])
        for other, kept in list(names.items())[:40]:
            assert len(set(kept) & set(values[a:b])) == len(other & brute)


def test_near_copies_never_share_a_bin(spark):
    """Copies that differ by a word, each from a source of its own, among short other texts."""
    rows = []
    for c in range(12):
        base = [f"c{c}x{i}" for i in range(60)]
        for j in range(5):
            w = base[:30] + [f"own{c}n{j}"] + base[31:]
            rows.append((100 * c + j, " ".join(w) if j else "\n ".join(w).upper(), f"s{c}n{j}"))
    rows += [(5000 + i, f"alone {i} " * 10, f"t{i}") for i in range(30)]
    rows += [(None, "no id " * 20 + "É", "u1"), (None, "no id " * 20 + "é", "u2"), (9000, None, "u3"), (9001, "", "u4")]
    got = K.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), capacity=512).collect()
    assert len(got) == len(rows)
    bins = defaultdict(list)
    for r in got:
        bins[r["bin_id"]].append(r["doc_id"])
    for members in bins.values():
        copies_of = [d // 100 for d in members if d is not None and d < 5000]
        assert len(copies_of) == len(set(copies_of)) and sum(d is None for d in members) <= 1
    assert max(len(m) for m in bins.values()) > 3               # different texts still share bins


def brute_model(rows):
    docs = [(d, words(t) + ["end"], zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0) for d, t in rows]
    count, pairs = Counter(), Counter()
    for _, w, held in docs:
        if not held:
            count.update(w)
            pairs.update(zip(["begin"] + w[:-1], w))
    after, left = Counter(), defaultdict(float)
    tally = lambda c: [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
    d2, seen = M.discounts(*tally(pairs)), Counter(w for _, w in pairs)
    d1 = M.discounts(*tally(seen))
    for (h, _), n in pairs.items():
        after[h] += n
        left[h] += d2[min(n, 3)]
    v, n, b = len(count), sum(count.values()), len(pairs)
    rest = sum(d1[min(c, 3)] for c in seen.values()) / b

    def p1(w):
        return max(seen[w] - d1[min(seen[w], 3)], 0) / b + rest / (v + 1)

    def p2(h, w):
        if not after[h]:
            return p1(w)
        c = pairs[(h, w)]
        return (max(c - d2[min(c, 3)], 0) + left[h] * p1(w)) / after[h]
    out = []
    for d, w, held in docs:
        out.append((d, held, len(w), sum(x in count for x in w), n,
                    sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w),
                    sum(math.log10(p2(h, x)) for h, x in zip(["begin"] + w[:-1], w))))
    return out, p2, count


@pytest.mark.parametrize("flush", [50, 2_000_000])
def test_language_model_matches_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(M, "FLUSH", flush)
    for docs in (edge_docs(spark), documents(spark, SMALL)):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        want, p2, count = brute_model(rows)
        got = [tuple(r)[:7] for r in M.train_and_score(docs).collect()]
        key = lambda r: (str(r[0]), r[2], round(r[6], 6))
        for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
            assert g[:5] == w[:5]
            assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)
        common = max(count, key=count.get)
        assert sum(p2(common, w) for w in count) + p2(common, "never seen") == pytest.approx(1)


def test_language_model_beats_its_base_on_held_out_text(spark):
    got = M.train_and_score(documents(spark, "/root/testdata/sf0.01")).where("held_out").agg(
        {"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > got["sum(base_score)"]


def test_language_model_visits_each_file_once_for_many_short_batches(spark, monkeypatch):
    """Every batch visited every file of the model, so the work grew with batches times files."""
    monkeypatch.setattr(M, "PART_TOKENS", 1000)
    rng = np.random.default_rng(4)
    rows = [(d, " ".join(f"w{i}" for i in rng.integers(0, 4000, 300))) for d in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, visits, get = M.train(docs), [], M._Arrays.get
    monkeypatch.setattr(M._Arrays, "get", lambda self, name: visits.append(name) or get(self, name))
    table = pa.table({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]})
    out = pa.Table.from_batches(M._score_batches(model)(iter(table.to_batches(max_chunksize=10))))
    files = len(os.listdir(model.folder))
    assert model.n_parts > 50 and files <= len(visits) + 1 <= 2 * files
    want = {r["doc_id"]: r["score"] for r in M.score(docs, model).collect()}
    assert out["doc_id"].to_pylist() == [d for d, _ in rows]
    assert out["score"].to_pylist() == pytest.approx([want[d] for d, _ in rows], rel=1e-12)


def test_language_model_without_training_rows(spark):
    assert M.train_and_score(empty_docs(spark)).count() == 0
    row = M.train_and_score(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).first()
    assert row["held_out"] and row["train_tokens"] == 0 and row["n_known"] == 0
