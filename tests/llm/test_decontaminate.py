import random
import re

import numpy as np
import pytest

from lodestone.llm import decontaminate as d

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def brute(docs, items, window=13):
    phrases = []
    for item, text in items:
        w = tokens(text)
        if item is not None and w:
            phrases += [(str(item), w[i : i + window]) for i in range(max(1, len(w) - window + 1))]
    out = []
    for doc, text in docs:
        w, hit, found = tokens(text), set(), set()
        for item, p in phrases:
            for i in range(len(w) - len(p) + 1):
                if w[i : i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    found.add(item)
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def data(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(60)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 12, 13, 14, 40])))) for i in range(6)] + [(7, None), (8, ""), (None, "w1"), (3, "Ünï w1, w2! W3")]
    docs = [(0, None), (1, ""), (2, "ünï-w1 w2/w3"), (2, "a"), (None, items[5][1])]
    for i in range(40):
        parts = [[word() if rng.random() < 0.6 else f"x{rng.randrange(9)}" for _ in range(rng.randrange(60))] for _ in range(2)]
        w = items[rng.randrange(6)][1].split()
        docs.append((i + 3, rng.choice([" ", ", ", "\n"]).join(parts[0] + w[rng.randrange(2) :] + parts[1])))
    return docs, items


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("block", [1 << 20, 200])
def test_equals_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(d, "BLOCK", block)
    docs, items = data(seed)
    df, bench = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_hit", "2 as items"), spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in d.find_contamination(df, bench).collect()]
    order = lambda x: (x[0] is None, x)
    assert sorted(got, key=order) == sorted(brute(docs, items), key=order)


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r.contaminated) for r in d.find_contamination(docs, bench).collect()] == [(2, 0, False)]
    assert d.find_contamination(docs.limit(0), bench).count() == 0


def test_very_long_text(spark):
    rng = random.Random(4)
    long = [f"w{rng.randrange(3000)}" for _ in range(120_000)]
    item = " ".join(f"w{rng.randrange(3000)}" for _ in range(30))
    docs = [(1, " ".join(long[:60_000]) + " " + item + " " + " ".join(long[60_000:])), (2, item), (3, " ".join(long))]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.contaminated) for r in d.find_contamination(df, bench).collect()}
    assert got == {1: (120_030, 30, False), 2: (30, 30, True), 3: (120_000, 0, False)}


def test_index_finds_all(seed=3):
    rng = np.random.default_rng(seed)
    for s in (rng.integers(1, 4, 300), np.full(200, 2), np.tile([2, 3, 1], 80)):
        s = np.append(s, 0)
        assert d.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        index = d.FMIndex(s, 5)
        for n in (1, 2, 5, 13):
            p = np.array([s[i : i + n] for i in range(0, 150, 7)])
            lo, hi = index.search(p, np.full(len(p), n))
            for x, a, b in zip(p, lo, hi, strict=True):
                assert sorted(index.locate(np.arange(a, b))) == [i for i in range(len(s) - n + 1) if (s[i : i + n] == x).all()]
        assert index.search(np.array([[4, 2]]), np.array([2]))[1] <= index.search(np.array([[4, 2]]), np.array([2]))[0]
