"""Exact search, product codes and ranked lexical search against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pledgewise.llm import codes, lexical, topk

from . import brute

VECTORS = "vec_id long, embedding array<float>, label int, v string, n long, score long, q int, rank int"
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def vectors(n=260, width=20, seed=5):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(width)], rng.choice([0, 1, 1, None])) for i in range(n)]
    rows += [(1000 + i, list(rows[7][1]), 1) for i in range(40)]  # a group of copies, all tied
    rows += [(2000, None, 1), (2001, [0.1, None, 0.2], 1), (2002, [float("nan")] * width, 1), (2003, [float("inf")] * width, 2)]
    rows += [(2010, [], 1), (2011, [0.5] * 3, None), (None, [0.4] * width, 1), (50, [rng.gauss(0, 0.3) for _ in range(width)], 0), rows[3], rows[3]]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2, 3, 4) for i, v, label in rows], VECTORS).repartition(3)


def kept(rows, scale):
    good = [(i, np.array(v, np.float32).astype(float), label) for i, v, label in rows if v is not None and None not in v]
    good = [x for x in good if np.isfinite(x[1]).all()]
    width = max((len(v) for _, v, _ in good), default=0)
    return [(i, [math.floor(scale * x) for x in v] + [0] * (width - len(v)), label) for i, v, label in good]


def plain_top(rows, k, every):
    rows, out = kept(rows, 256), []
    for i, v, _ in rows:
        if i is not None and i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j is None, j or 0) for j, w, _ in rows if j != i)
            out += [(i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"candidate_rows": 37, "query_rows": 9}])
def test_top_k(spark, sizes):
    rows = vectors()
    for k, every in ((5, 10), (400, 90)):
        assert collected(topk.top_k(table(spark, rows), k, every, **sizes), "query_id", "rank", "vec_id", "score") == plain_top(rows, k, every)


def test_top_k_of_wide_and_few_values(spark):
    large = [(i, [x * 3e4 for x in v] if v else v, label) for i, v, label in vectors(60) if v is None or None not in v]
    few = [(0, [1.0, 2.0], 1), (50, [3.0, -1.0], 1)]
    for rows in (large, few):
        assert collected(topk.top_k(table(spark, rows)), "query_id", "rank", "vec_id", "score") == plain_top(rows, 5, 50)
    assert topk.top_k(table(spark, few).where("false")).count() == 0
    assert topk.top_k(table(spark, few).where("vec_id = 50")).count() == 0
    assert topk.top_k(table(spark, [(1, [1.0], 1)])).count() == 0


def test_bounds_prune_and_keep_ties():
    rng = np.random.default_rng(1)
    candidates = rng.integers(-40, 40, (64, 500)) * np.geomspace(8, 0.1, 64).astype(int).clip(1)[:, None]
    candidates[:, 100:130] = candidates[:, [7]]
    queries = candidates[:, :20]
    scores = queries.T @ candidates
    np.fill_diagonal(scores, np.iinfo(np.int64).min)
    n_pairs = 0
    for q, c, score in topk.best(queries, candidates, lambda part: np.arange(20)[part][:, None] == np.arange(500), 5):
        n_pairs += len(q)
        assert (scores[q, c] == score).all()
        found = set(zip(q.tolist(), c.tolist(), strict=True))
        for i in range(20):
            edge = np.sort(scores[i])[-5]
            assert {(i, j) for j in np.flatnonzero(scores[i] >= edge).tolist()} <= found
    assert n_pairs < 20 * 500 / 2


def plain_codes(rows, parts=4, entries=256, rounds=4):
    rows = kept(rows, 1024)
    width = max(1, -(-max((len(v) for _, v, _ in rows), default=0) // parts))
    cut = [[(v + [0] * (parts * width - len(v)))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    first = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, cut[r]))[:entries]
    books = [[list(cut[r][p]) for r in first] for p in range(parts)]

    def assign(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [assign(p, c[p])[1] for c in cut]
            for e in set(own):
                held = [c[p] for c, o in zip(cut, own, strict=True) if o == e]
                books[p][e] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    found = [[assign(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, label), e in zip(rows, errors, strict=True):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted([(i, "".join(f"{e:02x}" for _, e in f), error, by_label[label], digest) for (i, _, label), f, error in zip(rows, found, errors, strict=True)], key=repr)


CODED = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def test_codes(spark):
    rows = [r for r in vectors(n=300, width=8) if r[0] != 50]  # entries of equal ids are ordered by doubles
    assert collected(codes.encode(table(spark, rows))[0], *CODED) == plain_codes(rows)
    assert collected(codes.encode(table(spark, rows), entries=16, rounds=2)[0], *CODED) == plain_codes(rows, entries=16, rounds=2)


def test_codes_of_few_large_and_no_rows(spark, monkeypatch):
    few = [(3, [0.5, -0.25, 1.0, 2.0, 0.1], 1), (1, [5e3, -6e4, 1.0], None), (2, None, 1)]
    assert collected(codes.encode(table(spark, few))[0], *CODED) == plain_codes(few)
    assert codes.encode(table(spark, few).where("false"))[0].count() == 0
    monkeypatch.setattr(codes, "BROADCAST", 0)
    rows = vectors(n=40, width=4)[:40]
    assert collected(codes.encode(table(spark, rows))[0], *CODED) == plain_codes(rows)


def test_nearest_entries_with_ties():
    rng = np.random.default_rng(2)
    book = rng.integers(-3, 3, (200, 4))
    parts = rng.integers(-4, 4, (3000, 4))
    index, distance = codes.nearest(parts, book)
    plain = ((parts[:, None] - book) ** 2).sum(axis=2)
    assert (distance == plain.min(axis=1)).all() and (index == plain.argmin(axis=1)).all()


def plain_search(docs, items, k=10):
    texts = [(i, Counter(TERMS.findall(brute.lower(t)))) for i, t in docs]
    n_docs, total = sum(1 for _, c in texts if c), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in texts:
            m = 10 + 90 * sum(c.values()) * n_docs // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(TERMS.findall(brute.lower(text))) if c[t])
            scored += [(-score, i is None, i or 0)] * (score > 0)
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


RANKED = ("item_id", "rank", "doc_id", "score")


def test_search(spark, docs, docs_df, empty_df, monkeypatch):
    passage = docs[3][1].split("\n")[0]
    items = [(1, passage), (2, "w1 w2 W3 w3, É 日本"), (3, None), (4, "..."), (5, "absent"), (5, "one two"), (5, "one two"), (None, "w7 w8 naïve"), (12, (passage + " w9 ") * 30), (6, "w1")]
    bench = spark.createDataFrame([(i, t, "z", 1) for i, t in items], "item_id long, text string, item string, rank int")
    want = plain_search(docs, items)
    assert collected(lexical.search(docs_df, bench), *RANKED) == want
    assert collected(lexical.search(docs_df, bench, block_pairs=7), *RANKED) == want
    monkeypatch.setattr(lexical, "SHARD", 40)  # several shards a task, as the bound of earlier ones counts
    monkeypatch.setattr(lexical, "DEPTH", 1)
    assert collected(lexical.search(docs_df.coalesce(1), bench, k=3), *RANKED) == plain_search(docs, items, 3)
    assert lexical.search(empty_df, bench).count() == 0
    assert lexical.search(docs_df, bench.where("false")).count() == 0


def test_lists_are_left_early_and_ties_stay():
    rng = random.Random(4)
    for _ in range(60):
        n, terms, k = rng.randint(1, 400), rng.randint(1, 6), rng.randint(1, 8)
        entries = [(t, d, rng.choice([1, 2, 5, 50, 50, rng.randint(1, 900)])) for t in range(terms) for d in range(n) if rng.random() < rng.choice([0.1, 0.9])]
        lists = lexical.Shard(list(range(n)), *(np.array([e[j] for e in entries], np.int64) for j in range(3)), terms)
        total = Counter()
        for _, d, x in entries:
            total[d] += x
        for reach in (0, max(total.values(), default=0)):
            docs, score = lists.best(np.arange(terms), k, reach)
            got = sorted(((-s, d) for d, s in zip(docs.tolist(), score.tolist(), strict=True)))[:k]
            want = [(-s, d) for d, s in total.items() if s >= max(reach, 1)]
            assert got == sorted(want)[:k]


def test_long_texts_are_searched_whole(spark):
    docs = [(1, "a " * 700_000 + "needle"), (2, "needle " + "b " * 400_000), (3, "needle a b"), (4, "a b")]
    items = [(1, "needle a"), (2, "b " * 300_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert collected(lexical.search(df, spark.createDataFrame(items, "item_id long, text string")), *RANKED) == plain_search(docs, items)
