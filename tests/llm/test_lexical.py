import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lodestone.llm import lexical as lx

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def tokens(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, count=10):
    held = [(d, Counter(tokens(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    N, L = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    of = {}
    for i, t in items:
        if i is not None and t:
            of.setdefault(i, set()).update(tokens(t))
    out = []
    for item, asked in of.items():
        scores = []
        for d, c, n in held:
            m = 10 + 90 * n * N // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores)[:count])]
    return sorted(out)


def data(seed, n=400):
    rng = random.Random(seed)
    word = lambda: rng.choice(["W", "w", "É", "é"]) + str(min(int(rng.expovariate(0.08)), 80))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 12, 40])))) for i in range(15)] + [(3, "w1, again"), (90, None), (91, " -- "), (None, "w1 w2"), (92, "absent")]
    docs = [(i, rng.choice([" ", ", ", "_", "\x00"]).join(word() for _ in range(rng.randrange(60)))) for i in range(n)]
    docs += [(None, "w1 w2 W1"), (n + 1, None), (n + 2, ""), (n + 3, "..."), (5, "w1"), (5, "w1")] + [(n + 10 + i, "w3 w4 w5 é6") for i in range(150)]
    docs.append((n + 500, "w7 " * 50_000))
    return docs, items


@pytest.mark.parametrize("tree,block", [(400_000, 1 << 20), (900, 250)])
def test_equals_brute_force(spark, monkeypatch, tree, block):
    monkeypatch.setattr(lx, "TREE", tree)
    monkeypatch.setattr(lx, "BLOCK", block)
    docs, items = data(tree)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as score").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 as doc_id")
    got = sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in lx.rank_documents(df, bench).collect())
    assert got == brute(docs, items)


def test_search_leaves_out_what_cannot_rank(monkeypatch):
    rng = np.random.default_rng(1)
    share = 0.9 ** np.arange(300) + 1e-3  # frequent terms first
    ranks = [np.sort(rng.choice(300, rng.integers(5, 30), replace=False, p=share / share.sum())) for _ in range(3000)]
    tfs = [rng.integers(1, 6, len(r)) for r in ranks]
    m = rng.integers(20, 400, 3000)
    tree = lx.Tree(ranks, tfs, m)
    assert max(h - lo for lo, h, a, b in zip(tree.low, tree.high, tree.first, tree.last, strict=True) if a == b) <= lx.LEAF
    weight = np.zeros(300, np.int64)
    weight[[0, 5, 30]] = 300, 900, 3000
    scored = []
    sums = lx.Tree._sums
    monkeypatch.setattr(lx.Tree, "_sums", staticmethod(lambda w, at, *a: (scored.append(a[-1] - a[-2] if at is tree.at else 0), sums(w, at, *a))[1]))
    best = tree.search(weight, [], 10, list(range(3000)))
    every = [int(lx.part_score(weight[r], t, np.full(len(r), k)).sum()) for r, t, k in zip(ranks, tfs, m, strict=True)]
    assert best == sorted((-s, False, i) for i, s in enumerate(every) if s)[:10]
    assert sum(scored) < 2000


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "b")], "item_id int, text string")
    assert [(r.item_id, r["rank"], r.doc_id) for r in lx.rank_documents(docs, items).collect()] == [(1, 1, 1)]
    assert lx.rank_documents(docs.limit(0), items).count() == 0
    assert lx.rank_documents(docs, items.limit(0)).count() == 0
