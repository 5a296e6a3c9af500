import random
from collections import defaultdict

import pytest

from lodestone.llm import neardup
from lodestone.llm.components import components


def brute(docs, k=5, percent=75):
    """Of each id: the sizes of its rows' sets and the least id that links reach."""
    sets, inverted, parent = [], defaultdict(list), {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for doc, text in docs:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    for i, ((doc, _), s) in enumerate(zip(docs, sets, strict=True)):
        if doc is None:
            continue
        both = defaultdict(int)
        for g in s:
            for j in inverted[g]:
                both[j] += 1
            inverted[g].append(i)
        find(doc)
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(docs[j][0]), find(doc)
                parent[max(a, b)] = min(a, b)
    return sorted(((d, len(s), find(d) if d is not None else None) for (d, _), s in zip(docs, sets, strict=True)), key=str)


def documents(seed):
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(30)}"
    docs = ["", None, " \n", "one", "ONE", "a b c d", "A b c d", "É x", "é x"]
    bases = [[word() for _ in range(rng.choice([5, 6, 8, 20, 60, 200]))] for _ in range(25)]
    passage = [word() for _ in range(40)]
    for _ in range(220):
        w = list(rng.choice(bases))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = word()
        docs.append(" ".join(w))
    docs += [" ".join([word() for _ in range(rng.randrange(14))] + passage + [word() for _ in range(rng.randrange(8))]) for _ in range(70)]  # crowded values, links and near misses
    big = [word() for _ in range(120)]
    for _ in range(80):
        w = list(big)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = word()
        docs.append(" ".join(w))
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed,crowd,block", [(0, 50, 256), (1, 10, 16), (2, 4, 16)])
def test_equals_brute_force(spark, monkeypatch, seed, crowd, block):
    monkeypatch.setattr(neardup, "CROWD", crowd)
    monkeypatch.setattr(neardup, "BLOCK", block)
    docs = documents(seed) + [(None, "a b c d"), (3, "three other words here now"), (5, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as node", "2 as component_id")
    rows = neardup.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str) == brute(docs)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)


def test_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (201, 200), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {201: 200}
