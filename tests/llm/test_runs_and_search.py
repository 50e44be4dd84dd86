"""Periodic runs, ranked lexical search and exact top-k search against brute force."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from lotwise.llm import lexical, runs, topk

DOCS = "doc_id long, text string, item_id string, n long, term string, score long, v string"


def brute_runs(words, least=6, times=4):
    """Each stretch that agrees with itself q words on, for every q; the smallest q of a stretch is its period."""
    found = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic(rng):
    words = rng.integers(0, rng.integers(1, 4), int(rng.integers(0, 60))).tolist()
    stretch = rng.integers(0, 3, int(rng.integers(1, 9))).tolist() * int(rng.integers(1, 8))
    at = int(rng.integers(0, len(words) + 1))
    return words[:at] + stretch + words[at:]


@pytest.mark.parametrize("least, times", [(6, 4), (100, 4), (6, 3), (1, 3), (3, 6)])
def test_runs_of_words(least, times):
    rng = np.random.default_rng(least * 10 + times)
    for _ in range(300):
        docs = [periodic(rng) for _ in range(3)]
        docs[1] = docs[0]  # copies are not paired with each other
        words = np.concatenate([np.array([*d, -1 - i]) for i, d in enumerate(docs)])
        salt = np.repeat(np.arange(3), [len(d) + 1 for d in docs])
        expected, at = [], 0
        for d in docs:
            expected += [(s + at, n, q) for s, n, q in brute_runs(d, least, times)]
            at += len(d) + 1
        assert runs.runs_of(words, salt, least, times) == sorted(expected)
    with pytest.raises(ValueError):
        runs.runs_of(np.arange(3), np.zeros(3), 6, 2)


def run_docs():
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, periodic(rng))) for _ in range(60)]
    texts += [None, "", " \t\n", "one", "a " * 40, "a b " * 30 + "c", "x " * 5, "x " * 6, "é é " * 12, "A a " * 9, "w " * 3000 + "v w " * 500]
    rows = [(i, t, "i", 1, "t", 2, "v") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[64], (None, "b " * 9, None, None, None, None, None), (None,) * 7]


def test_periodic_runs(spark):
    docs = spark.createDataFrame(run_docs(), DOCS).repartition(3)
    got = runs.periodic_runs(docs).collect()
    assert len(got) == len(run_docs())
    expected = []
    for i, t, *_ in run_docs():
        w = (t or "").encode().split()
        own = brute_runs(w)
        gone = {p for s, n, q in own for p in range(s + q, s + n)}
        expected.append((i, len(w), own, b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept)) for r in got)
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_runs_query(spark, tmp_path):
    docs = spark.createDataFrame(run_docs(), DOCS).dropDuplicates(["doc_id"]).where("doc_id is not null")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in runs.op11_runs(spark, str(tmp_path)).collect()}
    changed = 0
    for i, t, *_ in {r[0]: r for r in run_docs() if r[0] is not None}.values():
        w = (t or "").encode().split()
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            changed += 1
        own = brute_runs(w)
        gone = {p for s, m, q in own for p in range(s + q, s + m)}
        best = min(own, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        digests = [hashlib.sha256(x).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in own).encode(),
                                                           b" ".join(x for p, x in enumerate(w) if p not in gone))]
        r = got.pop(i)
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == (len(own), *best, milli, *digests)
    assert changed and not got


def test_very_long_texts(spark):
    rng = np.random.default_rng(1)
    texts = ["a " * 600_000, "x" * 2_000_000, " ".join(f"w{i % 1000}" for i in range(400_000)), " ".join(map(str, rng.integers(0, 2, 300_000)))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: r for r in runs.periodic_runs(docs).collect()}
    assert time.time() - start < 60
    assert [tuple(r) for r in got[0].runs] == [(0, 600_000, 1)] and got[0].kept == "a"
    assert got[1].runs == [] and got[1].n_words == 1
    assert [tuple(r) for r in got[2].runs] == [(0, 400_000, 1000)] and len(got[2].kept.split()) == 1000
    items = spark.createDataFrame([(1, "w1 w1 w7"), (2, "a x")], "item_id int, text string")
    assert {(r.item_id, r.doc_id) for r in lexical.search(docs, items).collect()} == {(1, 2), (2, 0)}


def brute_ranks(docs, items, k):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    cut = lambda t: Counter(re.findall("[0-9A-Za-z\x80-\U0010ffff]+", lower(t)))
    counted = [(i, cut(t)) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, length = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for name, text in set(items):
        scores = []
        for i, c in counted:
            m = 75 + (25 * c.total() * n_docs) // length
            score = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t, n in cut(text).items() if c[t])
            scores.append((-score, i is None, i))
        scores = sorted((s for s in scores if s[0] < 0), key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(name, text, rank + 1, i, -s) for rank, (s, _, i) in enumerate(scores)]
    return out


def search_rows(seed, n):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{min(int(rng.zipf(1.3)), 400)}"
    texts = [" ".join(word() for _ in range(int(rng.integers(1, 80)))) for _ in range(n)]
    texts += [texts[0]] * 30 + [None, "", " .,!", "W1 w1-W2", "été W3", "ÉTÉ w3"]
    rows = [(i, t, "i", 1, "t", 2, "v") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (None, texts[0], None, None, None, None, None), (None,) * 7]


@pytest.mark.parametrize("block, nodes, tree", [(4096, (256, 16), 512), (50, (8, 2), 3)])
def test_lexical(spark, monkeypatch, block, nodes, tree):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "BLOCK_ENTRIES", 40 * block)
    monkeypatch.setattr(lexical, "DOC_NODES", nodes)
    monkeypatch.setattr(lexical, "TREE_ITEMS", tree)
    rows = search_rows(block, 700)
    items = [(f"q{i}", rows[i * 13][1].upper() if i % 2 else " ".join(rows[i * 13][1].split()[:8] * 2)) for i in range(20)]
    items += [items[0], ("q1", "w1 w2 w2"), ("none", None), ("empty", ""), ("new", "unheard"), (None, "w3 é été w9")]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    asked = spark.createDataFrame([(*i, 7, 8) for i in items], "item_id string, text string, doc_id int, rank int")
    for k in (20,) if block > 50 else (1, 7):
        got = [(r.item_id, r.item_text, r.rank, r.doc_id, r.score) for r in lexical.search(docs, asked, k).collect()]
        assert sorted(map(str, got)) == sorted(map(str, brute_ranks([r[:2] for r in rows], items, k)))
    assert lexical.search(docs.limit(0), asked).count() == 0
    empty = lexical.search(docs, asked.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score", "item_text"]


def test_items_in_groups(spark, monkeypatch):
    rows = search_rows(3, 60)
    docs = spark.createDataFrame(rows, DOCS)
    items = [(i, rows[i][1]) for i in range(12)]
    asked = spark.createDataFrame(items, "item_id int, text string")
    monkeypatch.setattr(lexical, "GROUP_BYTES", 500)
    got = [(r.item_id, r.item_text, r.rank, r.doc_id, r.score) for r in lexical.search(docs, asked, 5).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_ranks([r[:2] for r in rows], items, 5)))


def test_bounds_leave_batches_out():
    """Blocks that can't reach the cutoff are not scored; those that can are."""
    rng = np.random.default_rng(0)
    lists = [np.unique(rng.integers(0, 50, 6)) for _ in range(400)]
    rows = lexical.Sparse(np.concatenate([[0], np.cumsum([len(x) for x in lists])]), np.concatenate(lists),
                          rng.integers(1, 100, sum(map(len, lists))))
    weight = np.ones(50, np.int64)
    docs = lexical.Tree(rows, weight, (64, 8))
    whole = np.zeros((400, 50), np.int64)
    whole[rows.rows(), rows.term] = rows.value
    for level, size in zip(docs.levels, docs.sizes, strict=True):
        for node in range(len(level)):
            below = whole[docs.order[node * size:(node + 1) * size]].max(0)
            own = np.zeros(50, np.int64)
            own[level.term[level.start[node]:level.start[node + 1]]] = level.value[level.start[node]:level.start[node + 1]]
            assert (own == below).all()
    item = lexical.Postings(lexical.Sparse(np.array([0, 3]), np.array([1, 2, 3]), np.array([5, 1, 2])), 50)
    live = rng.random((1, 400)) < 0.5
    products = whole[:, [1, 2, 3]] @ np.array([5, 1, 2])
    for exact in (True, False):
        assert (item.products(rows, live, exact)[0] == np.where(live[0], products, 0)).all()


def brute_topk(rows, asked, k):
    clean = lambda data: sorted({(i, tuple(math.floor(64 * x) for x in v)) for i, v in data
                                 if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, q in clean(asked):
        near = [(-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in clean(rows) if (j, v) != (i, q) and len(v) == len(q)]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(near)[:k])]
    return out


@pytest.mark.parametrize("vectors, queries, lists", [(4096, 512, 2), (40, 7, 3), (64, 16, 1), (50, 9, 8)])
def test_topk(spark, monkeypatch, vectors, queries, lists):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", vectors)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", queries)
    rng = np.random.default_rng(vectors)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(260)]
    rows += [(i, rows[0][1]) for i in range(300, 340)]  # equal vectors
    rows += [rows[5], (5, rows[6][1]), (None, rows[0][1]), (400, None), (401, []), (420, []), (402, [1.0, None] * 4), (403, [math.nan] * 8),
             (404, [math.inf] * 8), (405, [0.0] * 8), (406, [1.0, 2.0]), (440, [-3.0, 1.0]), (407, [1e6] * 8), (460, [-1e6] * 8)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, size int, list string").repartition(3)
    asked = df.where("vec_id % 20 = 0")
    for k in (1, 20) if lists == 2 else (3,):
        got = [(r.query_id, r.rank, r.vec_id, r.score) for r in topk.search(df, asked, k, lists=lists).collect()]
        assert sorted(got) == sorted(brute_topk(rows, [r for r in rows if r[0] is not None and r[0] % 20 == 0], k))
    assert topk.search(df.limit(0), asked).count() == 0
    assert topk.search(df, asked.limit(0)).count() == 0


def test_integers_of_any_size():
    """Products are exact where they fit; beyond that they are held to a bound."""
    left, right = np.array([[1 << 40, -3]]), np.array([[1 << 10, 5]])
    assert topk.wide_enough(left, right) is float
    assert topk.wide_enough(left, right * 50) is np.int64 and topk.wide_enough(left, right << 30) is object
    big = topk.held(left.astype(object) @ (right << 30).astype(object).T)
    assert big[0, 0] == 1 << topk.REACH
    width, data = topk.packed(np.array([[300, -5], [1, 2]]))
    assert width == 2 and (topk.unpacked(width, data, 2) == [[300, -5], [1, 2]]).all()
